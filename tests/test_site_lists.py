import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from guideloom.functions.sequences import text_to_dna
from guideloom.jobs import registry
from guideloom.operators import sites
from guideloom.sources import fasta


@pytest.fixture
def chunks(spark):
    """Two genomes and one without a name; one contig of a genome is there forty times, so that its sites fill several packed rows."""
    r = random.Random(8)
    dna = lambda n: "".join(r.choices("ACGTN", [9, 9, 9, 9, 1], k=n))
    hot = dna(300)
    rows = [(g, str(k), dna(400)) for g in ("a", "b", None) for k in range(5)] + [("a", f"h{k}", hot) for k in range(40)] + [("b", "none", ""), ("b", "null", None), ("c", "letterless", "N" * 50)]
    return sites.chunk_contigs(spark.createDataFrame(rows, "genome string, contig string, seq string").repartition(3), 100)


@pytest.mark.parametrize("reverse_slice", ["reference", "protospacer"])
def test_packed_lists_are_the_sites_in_order(spark, chunks, monkeypatch, reverse_slice):
    monkeypatch.setattr(sites, "PACKED_SITES", 7)
    lists = sites.packed_lists(chunks, reverse_slice)
    wanted = [tuple(r) for r in sites.sorted_sites(sites.extract_offtargets(chunks, reverse_slice)).collect()]
    assert [tuple(r) for r in sites.sorted_lists(lists).collect()] == wanted and {g for g, _ in wanted} == {"a", "b", None}
    places = [int(sites.unpacked(pa.array([r["ns"]])).sum()) for r in lists.collect()]
    assert sum(places) == len(wanted) and max(places) == 7
    assert max(wanted.count(w) for w in set(wanted)) > 2 * 7  # a site that fills rows


def test_written_lists_are_in_order(spark, chunks, tmp_path, monkeypatch):
    monkeypatch.setattr(sites, "PACKED_SITES", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one file
    try:
        fasta.write_site_lists(sites.packed_lists(chunks), str(tmp_path / "lists"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = [tuple(r) for r in sites.extract_offtargets(chunks).select("genome", "site").collect()]
    for genome, folder in (("a", "a"), ("b", "b"), (None, "__HIVE_DEFAULT_PARTITION__")):
        files = sorted((tmp_path / f"lists/genome={folder}").glob("part-*"))
        assert "".join(f.read_text() for f in files).splitlines() == sorted(s for own, s in rows if own == genome)
    assert len(list((tmp_path / "lists").glob("genome=a/part-*"))) > 1
    assert len(list((tmp_path / "lists").glob("genome=*"))) == 3


@pytest.mark.parametrize("run", ["sorted", "written"])
def test_chunks_are_scanned_once(spark, chunks, tmp_path, run):
    seen = spark.sparkContext.accumulator(0)
    n, counted = chunks.count(), chunks.withColumn("seq", F.udf(lambda s: seen.add(1) or s)("seq"))
    lists = sites.packed_lists(counted)
    sites.sorted_lists(lists).collect() if run == "sorted" else fasta.write_site_lists(lists, str(tmp_path / "lists"))
    assert seen.value == n


def test_sequences_of_chunks_are_made_once(spark):
    contigs = spark.createDataFrame([("g", "c", "some text")], "genome string, contig string, text string").withColumn("seq", text_to_dna(F.col("text")))
    plan = sites.chunk_contigs(contigs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("name", ["sorted_sites", "written_sites", "written_site_lists"])
def test_queries_make_no_row_a_site_before_the_order(spark, monkeypatch, name):
    monkeypatch.setattr(sites, "extract_offtargets", lambda *_: pytest.fail("rows of sites"))
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count()
