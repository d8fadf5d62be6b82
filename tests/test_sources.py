import gzip
import json
import random

from pyspark.sql import functions as F

from guideloom.operators import acquisition, sites, targets
from guideloom.sources import fasta, tables
from guideloom.streaming import streams


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fna").write_bytes(b">one >odd header\r\nacg\r\nTN\r\n>two\n>three\nAAAA")
    with gzip.open(tmp_path / "b.fna.gz", "wb") as f:
        f.write(b">one\nGG\nCC\n")
    (tmp_path / "c.txt").write_text("acgt\nacgt\n")
    rows = sorted((r["contig"].rsplit("/", 1)[-1], r["seq"]) for r in fasta.read_fasta(spark, [str(tmp_path / x) for x in ("a.fna", "b.fna.gz", "c.txt")], "g", partitions=3).collect())
    assert rows == [("c.txt", "ACGTACGT"), ("one", "GGCC"), ("one >odd header", "ACGTN"), ("three", "AAAA"), ("two", "")]


def test_sites_file(spark, tmp_path):
    df = spark.createDataFrame([("g", s) for s in "CABA"], "genome string, site string")
    fasta.write_sites(df, str(tmp_path / "s"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "s")).collect()] == list("AABC")


def test_requests_and_messages(spark, tmp_path):
    bodies = ['{"sequence": "ACGT", "genome": "g"}', '{"sequence": "ACGT"}', '{"genome": "g"}', "{broken", "", "[]", "null"]
    rows = tables.parse_jobs(spark.createDataFrame([(b,) for b in [*bodies, None]], "value string")).collect()
    assert [r["reject_reason"] for r in rows] == [None, "no genome", "no sequence", "bad json", "no body", "bad json", "bad json", "no body"]
    (tmp_path / "x.json").write_text("\n".join(bodies[:2]))
    assert tables.read_jobs(spark, str(tmp_path)).count() == 2
    inner = json.dumps({"JobID": "j", "TargetID": 3, "Sequence": "ACGT"})
    messages = [json.dumps({"default": inner, "genome": json.dumps("g")}), json.dumps({"default": json.dumps({"JobID": "j"}), "genome": "1"}), "{", None]
    decoded = tables.decode_messages(spark.createDataFrame([(m,) for m in messages], "body string")).collect()
    assert [tuple(r) for r in decoded] == [("j", 3, "ACGT", "g")]
    assert tables.read_objects(spark, str(tmp_path)).collect()[0]["size"] == len("\n".join(bodies[:2]))


def test_keyed_writes(spark, tmp_path):
    path = str(tmp_path / "targets")
    make = lambda job, seqs: spark.createDataFrame([(job, k, s) for k, s in enumerate(seqs)], "job_id string, target_id long, sequence string")
    tables.write_targets(make("a", ["x", "y"]), path, buckets=2**20)
    tables.write_targets(make("b", ["z"]), path, buckets=2**20)
    tables.write_targets(make("a", ["w"]), path, buckets=2**20)
    assert sorted((r["job_id"], r["sequence"]) for r in spark.read.parquet(path).collect()) == [("a", "w"), ("b", "z")]


def test_jobs_that_share_a_bucket(spark, tmp_path):
    path = str(tmp_path / "targets")
    make = lambda rows: spark.createDataFrame(rows, "job_id string, target_id long, sequence string")
    for rows in ([("a", 0, "x"), ("b", 0, "y")], [("c", 0, "z")], [("a", 0, "w"), ("a", 1, "v")], []):
        tables.write_targets(make(rows), path, buckets=1)
    assert sorted((r["job_id"], r["sequence"]) for r in spark.read.parquet(path).collect()) == [("a", "v"), ("a", "w"), ("b", "y"), ("c", "z")]


def test_part_plans(spark):
    m = 50_000_000
    files = spark.createDataFrame([(str(s), s) for s in (0, 1, m, m + 1, 2 * m)], "filename string, file_size long")
    plan = acquisition.plan_parts(files)
    got = {}
    for r in plan.orderBy("part").collect():
        got.setdefault(r["filename"], []).append((r["part"], r["start_byte"], r["end_byte"], r["multipart"]))
    assert got == {"0": [(1, 0, -1, False)], "1": [(1, 0, 0, False)], str(m): [(1, 0, m - 1, False)], str(m + 1): [(1, 0, m - 1, True), (2, m, m, True)], str(2 * m): [(1, 0, m - 1, True), (2, m, 2 * m - 1, True)]}
    parts = spark.createDataFrame([(str(m + 1), 1, "a"), (str(m + 1), 1, "a"), (str(2 * m), 1, "a"), (str(2 * m), 2, "b"), ("1", 7, "x")], "filename string, part int, etag string")
    status = {r["filename"]: (r["n_present"], r["complete"]) for r in acquisition.file_status(plan, parts).collect()}
    assert status == {"0": (0, False), "1": (0, False), str(m): (0, False), str(m + 1): (1, False), str(2 * m): (2, True)}
    latest = acquisition.latest_by_key(parts.withColumn("v", F.when(F.col("etag") == "b", 2).otherwise(1)), ["filename"], "v")
    assert {r["filename"]: r["etag"] for r in latest.collect()}[str(2 * m)] == "b"


def test_streamed_guides_and_rejects(spark, tmp_path):
    for d in ("in", "out", "bad", "state"):
        (tmp_path / d).mkdir()
    seq = "ATCGATCGATCGATCGATCGAGG ATCGATCGATCGATCGATCGTGG\nCCAATCGATCGATCGATCGATCG"
    lines = [{"job_id": "a", "sequence": seq, "genome": "g"}] * 2 + [{"job_id": "b", "sequence": "", "genome": "g"}]
    (tmp_path / "in/x.json").write_text("\n".join(map(json.dumps, lines)))
    query = streams.start_scoring(streams.stream_jobs(spark, str(tmp_path / "in")), targets.design_guides, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "state"), {"availableNow": True})
    query.awaitTermination()
    read = spark.read.option("recursiveFileLookup", "true")
    assert read.parquet(str(tmp_path / "out")).count() == 3
    assert [r["reject_reason"] for r in read.parquet(str(tmp_path / "bad")).collect()] == ["empty"]


def test_jobs_delivered_again_in_a_later_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seq = "ATCGATCGATCGATCGATCGAGG ATCGATCGATCGATCGATCGTGG\nCCAATCGATCGATCGATCGATCG"
    jobs = [{"job_id": "a", "sequence": seq, "genome": "g"}, {"job_id": "b", "sequence": "", "genome": "g"}, {"job_id": "c", "sequence": seq, "genome": "g"}]
    for name, delivered in (("x", jobs[:2]), ("y", jobs), ("z", jobs)):
        (tmp_path / f"in/{name}.json").write_text("\n".join(map(json.dumps, delivered)))
        paths = [str(tmp_path / d) for d in ("out", "bad", "state")]
        streams.start_scoring(streams.stream_jobs(spark, str(tmp_path / "in")), targets.design_guides, *paths, {"availableNow": True}).awaitTermination()
    read = spark.read.option("recursiveFileLookup", "true")
    assert sorted(r["job_id"] for r in read.parquet(str(tmp_path / "out")).collect()) == ["a"] * 3 + ["c"] * 3
    assert [r["job_id"] for r in read.parquet(str(tmp_path / "bad")).collect()] == ["b"]


def test_watermark_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "2024-01-01 00:00:00"), ("a", 1, "2024-01-01 00:01:00"), ("a", 2, "2024-01-01 00:02:00")], "job_id string, target_id long, ts string").selectExpr("job_id", "target_id", "cast(ts AS timestamp) AS ts")
    rows.coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = streams.without_redelivery(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "ev")), ["job_id", "target_id"])
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "st")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_fasta_lines_across_blocks(spark, tmp_path):
    rng = random.Random(4)
    long = "".join(rng.choice("ACGT") for _ in range(1000))
    body = b">one >odd header\r\nacg\r\nTN\r\n>two\n>three\n" + b"\n".join(long[i : i + 37].encode() for i in range(0, 1000, 37)) + b"\n>one >odd header\nGG \n\nCC"
    (tmp_path / "a.fna").write_bytes(body)
    (tmp_path / "c.txt").write_text("acgt\nacgt\n")
    with gzip.open(tmp_path / "b.fna.gz", "wb") as f:
        f.write(b">z\nA\nC\n")
    want = [("c.txt", "ACGTACGT"), ("one >odd header", "ACGTN"), ("one >odd header", "GGCC"), ("three", long), ("z", "AC")]
    for block in ("64", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            lines = fasta.read_fasta_lines(spark, [str(tmp_path / x) for x in ("a.fna", "b.fna.gz", "c.txt")], "g")
            whole = {}
            for r in lines.collect():
                whole.setdefault((r["file"], r["record"], r["contig"].rsplit("/", 1)[-1]), []).append((r["offset"], r["seq"]))
            assert sorted((k[2], "".join(x for _, x in sorted(v))) for k, v in whole.items()) == want
            assert all(o == len("".join(x for _, x in sorted(v)[:i])) for v in whole.values() for i, (o, _) in enumerate(sorted(v)))
            contigs = spark.createDataFrame([("g", c, s) for c, s in want], "genome string, contig string, seq string")
            for size in (1, 10, 64, 5000):
                of = lambda df: sorted((r["contig"].rsplit("/", 1)[-1], r["chunk_id"], r["offset"], r["seq"]) for r in df.collect())
                assert of(sites.chunk_lines(lines, size)) == of(sites.chunk_contigs(contigs, size))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_old_jobs_and_jobs_that_cannot_be_scored(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = {d: str(tmp_path / d) for d in ("in", "out", "bad", "state", "dead")}
    seq = "ATCGATCGATCGATCGATCGAGG"
    job = lambda name, at: {"job_id": name, "sequence": seq, "genome": "g", "submitted_at": at}
    lines = [job(str(k), "2999-01-01T00:00:00Z") for k in range(9)] + [job("old", "2020-01-01T00:00:00Z"), {"job_id": "undated", "sequence": seq}]

    def deliver(name, rows, broken):
        (tmp_path / f"in/{name}.json").write_text("\n".join(map(json.dumps, rows)))
        score = lambda accepted: targets.design_guides(accepted).withColumn("ok", F.when(F.col("job_id").isin(broken), F.raise_error(F.lit("no score"))).otherwise("yes"))
        streams.start_scoring(streams.stream_jobs(spark, paths["in"]), score, paths["out"], paths["bad"], paths["state"], {"availableNow": True}, max_age="30 minutes", dead_letters=paths["dead"], tries=2).awaitTermination()

    read = lambda d: sorted(r["job_id"] for r in spark.read.option("recursiveFileLookup", "true").parquet(paths[d]).collect())
    deliver("x", lines, ["3", "5"])
    assert read("out") == [*"0124678", "undated"] and read("bad") == ["old"] and read("dead") == ["3", "5"]
    assert {"no score" in r["error"] for r in spark.read.parquet(paths["dead"]).collect()} == {True}
    deliver("y", lines[3:6], ["5"])  # 4 again is left out, 3 can be scored now, 5 fails alone
    assert read("out") == [*"01234678", "undated"] and read("bad") == ["old"] and read("dead") == ["3", "5", "5"]


def test_index_job_once_a_genome(spark, tmp_path):
    plan = spark.createDataFrame([("g", "a", 2), ("g", "b", 1), ("h", "c", 2)], "genome string, filename string, parts_per_file int")
    found = []
    for name, parts in (("x", [("a", 1), ("a", 1), ("b", 1)]), ("y", [("a", 2), ("c", 1), ("c", 7)]), ("z", [("a", 1), ("b", 1), ("c", 1)])):
        spark.createDataFrame(parts, "filename string, part int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("filename string, part int").parquet(str(tmp_path / "in"))
        streams.start_index_jobs(streams.stream_genome_status(stream, plan), str(tmp_path / "out"), str(tmp_path / "state"), {"availableNow": True}).awaitTermination()
        found.append([tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("genome", "num_files", "num_parts").collect()])
    assert found == [[], [("g", 2, 3)], [("g", 2, 3)]]


def test_progress_forgets_what_the_watermark_has_passed(spark, tmp_path):
    schema = "job_id string, target_id long, stage string, ts timestamp"
    row = lambda target, stage, minute: f"SELECT 'a' job_id, {target}L target_id, '{stage}' stage, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {minute}, 0) ts"
    counts, states = [], []
    for rows in ([row(1, "guide", 0), row(1, "guide", 1), row(1, "ontarget", 2)], [row(1, "guide", 0), row(2, "guide", 100)], [row(3, "guide", 0), row(2, "guide", 101)]):
        spark.sql(" UNION ALL ".join(rows)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = streams.stream_progress(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("update").foreachBatch(lambda b, _: counts.extend(tuple(r)[1:] for r in b.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        states.append(min(p["stateOperators"][1]["numRowsTotal"] for p in map(lambda x: json.loads(x.json), query.recentProgress)))
    assert counts == [(1, 1, 0), (2, 1, 0)]  # late and repeated rows change nothing
    assert states[-1] <= 1
