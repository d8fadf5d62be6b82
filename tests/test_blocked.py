"""Blocked gzip: members found by tasks, lines cut by members put together, damage told."""

import gzip
import random

import pytest
from guideloom.sources import blocked, fasta


def chain(data, size):
    return b"".join(blocked.packed(data[i : i + size]) for i in range(0, len(data), size)) + blocked.END


def contigs_of(rows):
    whole = {}
    for r in rows:
        whole.setdefault((r["file"].rsplit("/", 1)[-1], r["record"], r["contig"].rsplit("/", 1)[-1]), []).append((r["offset"], r["seq"]))
    for pieces in whole.values():
        pieces.sort()
        assert all(o == len("".join(s for _, s in pieces[:i])) for i, (o, _) in enumerate(pieces))
    return sorted((k[0], k[1], k[2], "".join(s for _, s in v)) for k, v in whole.items())


@pytest.mark.parametrize("size", [1, 2, 7, 64, 60_000])
@pytest.mark.parametrize("ranges", [1, 6])
def test_lines_cut_by_members(spark, tmp_path, size, ranges):
    rng = random.Random(size)
    long = "".join(rng.choice("ACGT") for _ in range(700))
    body = b">one >odd header\r\nacg\r\nTN\r\n\r\n>empty\n>three\n" + b"\n".join(long[i : i + 37].encode() for i in range(0, 700, 37)) + b"\n>one >odd header\nGG \n\nCC"
    data = {"a.fna.bgz": body, "b.bgz": b"acgt\nac\n>z\xc3\xa9 \nA\nC\n", "c.bgz": b"", "d.bgz": b">" + b"n" * 90}
    for name, raw in data.items():
        (tmp_path / name).write_bytes(chain(raw, size))
        assert gzip.decompress((tmp_path / name).read_bytes()) == raw
    spark.conf.set("spark.sql.files.maxPartitionBytes", str((tmp_path / "a.fna.bgz").stat().st_size // ranges + 1))
    try:
        rows = fasta.read_fasta_lines(spark, [str(tmp_path / x) for x in data], "g", blocked=True).collect()
        n_ranges = blocked.read_members(spark, str(tmp_path / "a.fna.bgz")).select("block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [("a.fna.bgz", 1, "one >odd header", "ACGTN"), ("a.fna.bgz", 3, "three", long), ("a.fna.bgz", 4, "one >odd header", "GGCC"), ("b.bgz", 0, "b.bgz", "ACGTAC"), ("b.bgz", 1, "zé", "AC")]  # a header without bases gives no row, as in plain files
    assert contigs_of(rows) == want and {r["genome"] for r in rows} == {"g"}
    assert n_ranges == (2 if size == 60_000 and ranges == 6 else ranges)  # many tasks for one file, if it has many members


def test_written_files_are_gzip(spark, tmp_path):
    rng = random.Random(5)
    lines = ["", None, "é" * 40_000, "A" * 200_000] + ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(5000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i")
    blocked.write_blocked(rows, str(tmp_path / "out"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "out").glob("part-*")))
    assert raw.decode() == "".join((x or "") + "\n" for x in lines)
    blocked.write_blocked(rows.filter("i < 0"), str(tmp_path / "none"))
    assert blocked.read_stretches(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("harm", ["plain", "cut", "bit"])
def test_damage_is_an_error(spark, tmp_path, harm):
    raw = chain(b">a\n" + b"ACGT" * 500, 300)
    (tmp_path / "a.bgz").write_bytes(gzip.compress(b">a\nACGT\n") if harm == "plain" else raw[:-40] if harm == "cut" else raw[:30] + bytes([raw[30] ^ 4]) + raw[31:])
    with pytest.raises(Exception, match="blocked gzip|zlib|decompress"):
        fasta.read_fasta_lines(spark, str(tmp_path / "a.bgz"), blocked=True).collect()


def test_names_that_the_source_would_unpack(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(blocked.END)
    with pytest.raises(ValueError, match="bgz"):
        blocked.read_members(spark, str(tmp_path / "a.gz"))


@pytest.mark.parametrize("blocked_form", [True, False])
def test_headers_without_bases(spark, tmp_path, blocked_form):
    raw = b">a\n>b\nAC\nGT\n>a\n\n>c"
    (tmp_path / "x.bgz").write_bytes(chain(raw, 3) if blocked_form else raw)
    rows = fasta.read_fasta_lines(spark, str(tmp_path / "x.bgz"), blocked=blocked_form, headers=True).collect()
    assert [r[1:] for r in contigs_of(rows)] == [(1, "a", ""), (2, "b", "ACGT"), (3, "a", ""), (4, "c", "")]


def test_documents_without_letters_are_contigs(spark, tmp_path):
    from guideloom.jobs import queries

    spark.createDataFrame([(1, "ab ab", "en"), (2, "12 3!", "en"), (3, "", "de")], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted((r["contig"], r["n"]) for r in queries.fasta_blocked_gzip(spark, str(tmp_path)).collect()) == [("1", 4), ("2", 0), ("3", 0)]


def test_ranges_may_change_between_readings(spark, tmp_path):
    """The cores of a cluster decide the byte ranges of a file, and may change while a query runs."""
    rng = random.Random(9)
    contigs = {f"c{k}": "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 900))) for k in range(300)}
    (tmp_path / "x.bgz").write_bytes(chain("".join(f">{k}\n{v}\n" for k, v in contigs.items()).encode(), 500))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        rows = fasta.read_fasta_lines(spark, str(tmp_path / "x.bgz"), blocked=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        found = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r[2]: r[3] for r in contigs_of(found)} == contigs
