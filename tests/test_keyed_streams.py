import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from guideloom.streaming import keyed, streams

SEQ = "ATCGATCGATCGATCGATCGAGG"
NOW = {"availableNow": True}


def paths_of(tmp_path):
    (tmp_path / "in").mkdir()
    return {d: str(tmp_path / d) for d in ("in", "out", "bad", "state", "dead")}


def deliver(tmp_path, name, rows):
    (tmp_path / f"in/{name}.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def job(name, genome="g"):
    return {"job_id": name, "sequence": SEQ, "genome": genome, "submitted_at": "2024-01-01T00:00:00Z"}


def lengths(accepted):
    return accepted.select("job_id", F.length("sequence").alias("n"))


def read(spark, folder, column="job_id"):
    return sorted([r[column] for r in spark.read.option("recursiveFileLookup", "true").parquet(folder).collect()], key=repr)


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    p = paths_of(tmp_path)
    for name in "ab":
        deliver(tmp_path, name, [job(name)])
        source = streams.stream_jobs(spark, p["in"])
        streams.start_scoring(source, lengths, p["out"], p["bad"], f"{p['state']}-{name}", NOW).awaitTermination()
    assert read(spark, p["out"]) == ["a", "a", "b"]  # the second checkpoint knows nothing of the first, and both keep their results
    plain = spark.read.parquet(p["out"])
    assert plain.select("run").distinct().count() == 2 and plain.groupBy("run", "job_id").count().filter("count > 1").count() == 0


def test_requests_without_an_id_are_rejected_each(spark, tmp_path):
    p = paths_of(tmp_path)
    nameless = {k: v for k, v in job("x").items() if k != "job_id"}
    deliver(tmp_path, "x", ["{broken", "{broken too", "[]", "[{}]", nameless, nameless, job("a")])
    for _ in range(2):
        streams.start_scoring(streams.stream_jobs(spark, p["in"]), lengths, p["out"], p["bad"], p["state"], NOW).awaitTermination()
    deliver(tmp_path, "y", [nameless, job("a")])
    streams.start_scoring(streams.stream_jobs(spark, p["in"]), lengths, p["out"], p["bad"], p["state"], NOW).awaitTermination()
    # an empty list holds no request
    assert read(spark, p["bad"], "reject_reason") == ["no job id"] * 6 and read(spark, p["out"]) == ["a"]


def test_no_earlier_output_is_read(spark, tmp_path):
    p, plans = paths_of(tmp_path), []

    def score(accepted):
        plans.append(accepted._jdf.queryExecution().toString())
        return lengths(accepted)

    for name in "ab":
        deliver(tmp_path, name, [job("a"), job(name)])
        streams.start_scoring(streams.stream_jobs(spark, p["in"]), score, p["out"], p["bad"], p["state"], NOW).awaitTermination()
    assert read(spark, p["out"]) == ["a", "b"] and len(plans) == 2 and not any(p["out"] in x or p["bad"] in x for x in plans)


def test_an_outage_stops_the_stream(spark, tmp_path):
    p, runs = paths_of(tmp_path), []
    deliver(tmp_path, "x", [job(str(k)) for k in range(40)])

    def start(broken):
        def score(accepted):
            runs.append(1)
            return lengths(accepted).withColumn("n", F.raise_error(F.lit("no index")).cast("int")) if broken else lengths(accepted)

        streams.start_scoring(streams.stream_jobs(spark, p["in"]), score, p["out"], p["bad"], p["state"], NOW, dead_letters=p["dead"], tries=3).awaitTermination()

    with pytest.raises(StreamingQueryException, match="no index"):
        start(True)
    assert len(runs) == 3 and not (tmp_path / "dead").exists() and not (tmp_path / "out").exists()
    start(False)  # the batch runs again
    assert len(read(spark, p["out"])) == 40 and read(spark, p["dead"]) == []


def test_failed_rows_are_tried_again_and_counted(spark, tmp_path):
    p, seen = paths_of(tmp_path), []
    before = os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    deliver(tmp_path, "x", [job("a"), job("b"), job("c")])

    def start(failing, more=()):
        if more:
            deliver(tmp_path, f"more{len(seen)}", more)
        score = lambda accepted: lengths(accepted).withColumn("error", F.when(F.col("job_id").isin(failing), "no score"))
        streams.start_scoring(streams.stream_jobs(spark, p["in"]), score, p["out"], p["bad"], p["state"], NOW, dead_letters=p["dead"], tries=2).awaitTermination()
        seen.append((read(spark, p["out"]), read(spark, p["dead"])))

    start(["a", "b"])
    start(["b"], [job("b"), job("c")])  # a waiting try and a finished job, delivered again: neither counts
    start(["b"])
    start([], [job("b")])  # after it was given up, it is new
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [f for f in os.listdir(shared) if f.startswith("batch-") and f not in before]  # nothing stays of what the steps share
    assert seen == [(["c"], []), (["a", "c"], ["b"]), (["a", "c"], ["b"]), (["a", "b", "c"], ["b"])]
    assert {r["attempt"] for r in spark.read.option("recursiveFileLookup", "true").parquet(p["dead"]).collect()} == {2}


def run(spark, tmp_path, stream, name="rows"):
    """What one run of a stateful stream gives, and the rows of its state."""
    found = []
    with keyed.state_settings(spark, NOW):
        query = stream.writeStream.foreachBatch(lambda batch, _: found.extend(tuple(r) for r in batch.collect())).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(**NOW).start()
    query.awaitTermination()
    progress = [json.loads(x.json) for x in query.recentProgress]
    return sorted(found), progress[-1]["stateOperators"][0]["numRowsTotal"] if progress else None


def test_settings_last_only_for_the_start(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with keyed.state_settings(spark, NOW, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3" and "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_jobs_wait_for_their_index(spark, tmp_path):
    jobs, index = "job_id string, sequence string, genome string, submitted_at timestamp", "genome string"
    add = lambda rows, schema, folder: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / folder))
    asked = lambda *ids: add([(i, "ACGT", g, None) for i, g in ids], jobs, "jobs")
    ready = lambda *names: add([(n,) for n in names], index, "indexes")
    stream = lambda keep: keyed.released_jobs(spark.readStream.schema(jobs).parquet(str(tmp_path / "jobs")), spark.readStream.schema(index).parquet(str(tmp_path / "indexes")), spark.createDataFrame([("known",)], index), keep_days=keep, salt=3)
    got = lambda keep=1.0: [(r[0], r[1], r[4]) for r in run(spark, tmp_path, stream(keep))[0]]
    asked(("1", "g"), ("2", "g"), ("3", "h"), ("4", "known"), ("1", "g")), ready("early")
    assert got() == [("known", "4", "released")]
    asked(("5", "early"), ("1", "g"), ("6", "g")), ready("other")
    assert got() == [("early", "5", "released")]
    ready("g", "g"), asked(("7", "g"))
    assert got() == [("g", k, "released") for k in "1267"]
    asked(("1", "g"), ("2", "g"), ("8", "g"), ("3", "h")), ready("g")
    assert got() == [("g", "8", "released")]  # once each
    ready("h")
    assert got() == [("h", "3", "released")]


def test_jobs_do_not_wait_for_ever(spark, tmp_path):
    jobs, index = "job_id string, sequence string, genome string, submitted_at timestamp", "genome string"
    add = lambda rows, schema, folder: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / folder))
    stream = lambda: keyed.released_jobs(spark.readStream.schema(jobs).parquet(str(tmp_path / "jobs")), spark.readStream.schema(index).parquet(str(tmp_path / "indexes")), keep_days=0.5 / 86_400)
    add([(str(k), "A", "g", None) for k in range(20)], jobs, "jobs"), add([], index, "indexes")
    assert run(spark, tmp_path, stream())[0] == []
    time.sleep(1)
    add([("x", "A", "h", None)], jobs, "jobs")
    assert [r[1:5:3] for r in run(spark, tmp_path, stream())[0]] == sorted((str(k), "expired") for k in range(20))
    time.sleep(1)
    add([("y", "A", "h", None)], jobs, "jobs")
    found, state = run(spark, tmp_path, stream())
    assert [r[1:5:3] for r in found] == [("x", "expired")] and state <= 4  # nothing of the first twenty stays


def test_uploads_complete_once_or_expire(spark, tmp_path):
    plan = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1), ("big", 3000), ("c", 1)], "filename string, parts_per_file long")
    add = lambda rows: spark.createDataFrame(rows, "filename string, part int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = lambda keep, name="kept": run(spark, tmp_path, keyed.finished_uploads(spark.readStream.schema("filename string, part int").parquet(str(tmp_path / "in")), plan, keep_days=keep), name)
    add([("a", 1), ("unknown", 1), ("c", 1), ("c", 1), ("c", 0), ("a", 3), *[("big", k) for k in range(1, 3000)]])
    assert got(1)[0] == [("c", 1, 1, "complete")]
    add([("a", 2), ("c", 1), ("big", 3000)])
    assert got(1)[0] == [("a", 2, 2, "complete"), ("big", 3000, 3000, "complete")]
    add([("b", 1), ("b", 1), ("b", 9), ("a", 1)])
    soon = 1e-3 / 86_400
    assert got(soon)[0] == []
    add([("unknown", 1)])
    assert got(soon)[0] == [("b", 3, 1, "expired")]
    # another stream over the same parts: when all have gone, nothing stays
    assert got(soon, "short")[0] == [("a", 2, 2, "complete"), ("big", 3000, 3000, "complete"), ("c", 1, 1, "complete")]
    add([("unknown", 1)])
    found, state = got(soon, "short")
    assert found == [("b", 3, 1, "expired")] and state == 0


def test_genomes_complete_once_or_expire(spark, tmp_path):
    plan = spark.createDataFrame([("g", "a", 2), ("g", "b", 1), ("h", "c", 2), ("g", "a", 2)], "genome string, filename string, parts_per_file int")
    add = lambda rows: spark.createDataFrame(rows, "filename string, part int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = lambda keep, name="kept": run(spark, tmp_path, keyed.finished_genomes(spark.readStream.schema("filename string, part int").parquet(str(tmp_path / "in")), plan, keep_days=keep), name)
    add([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("x", 1)])
    assert got(1)[0] == []
    add([("b", 1), ("a", 1), ("a", 2)])
    assert got(1)[0] == [("g", 2, 2, "complete")]
    add([("a", 1), ("c", 1), ("c", 7)])
    soon = 1e-3 / 86_400
    assert got(soon)[0] == []
    add([("x", 1)])
    assert got(soon)[0] == [("h", 1, 0, "expired")]
    assert got(soon, "short")[0] == [("g", 2, 2, "complete")]
    add([("x", 1)])
    found, state = got(soon, "short")
    assert found == [("h", 1, 0, "expired")] and state == 0


@pytest.mark.parametrize("name", ["uploads", "genomes"])
def test_state_of_many_files_lies_in_buckets(spark, tmp_path, name):
    """A few state rows a bucket, however many files are open: Python asks the store a few times a key."""
    n = 20_000
    files = spark.range(n).select(F.concat(F.lit("f"), "id").alias("filename"), (F.col("id") % 3 + 1).cast("int").alias("parts_per_file"), F.floor(F.col("id") / 2).cast("string").alias("genome"))
    parts = files.select("filename", F.lit(1).alias("part"))
    parts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(parts.schema).parquet(str(tmp_path / "in"))
    stream = keyed.finished_uploads(stream, files) if name == "uploads" else keyed.finished_genomes(stream, files)
    found, state = run(spark, tmp_path, stream)
    assert len(found) == (6667 if name == "uploads" else 0) and state <= 3 * 4096
    parts.withColumn("part", F.explode(F.array(F.lit(3), F.lit(2)))).write.mode("append").parquet(str(tmp_path / "in"))
    found, _ = run(spark, tmp_path, stream)
    assert len(found) == (n - 6667 if name == "uploads" else n // 2) and {r[3] for r in found} == {"complete"}
