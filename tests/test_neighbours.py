import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from guideloom.operators import efficiency, sites, specificity
from guideloom.sources import fasta, tables

INDEX = "genome string, code long, n long"


def random_sites(n, seed, hot=0.0):
    r = random.Random(seed)
    base = [r.getrandbits(40) for _ in range(30)]
    codes = set()
    while len(codes) < n:
        code = r.choice(base)
        for _ in range(r.randrange(7)):
            code ^= r.randrange(1, 4) << 2 * r.randrange(20)
        codes.add(code % (1 << 32) if r.random() < hot else code)
    return [(r.choice("gh"), c, r.randrange(1, 4)) for c in sorted(codes)]


@pytest.fixture(scope="module")
def tables_of(spark):
    rows = random_sites(900, 1, hot=0.4)
    counted = spark.createDataFrame(rows, INDEX)
    guides = spark.createDataFrame([(g, c ^ 5 if k % 2 else c) for k, (g, c, _) in enumerate(rows) if k % 20 == 0] + [("none", 1)], "genome string, guide_code long").distinct()
    return guides.cache(), counted.cache()


def found(df):
    return sorted(tuple(r) for r in df.select("genome", "guide_code", "code", "n", "mask", "mismatches").collect())


def plain(guides, counted):
    out = []
    for g in guides.collect():
        for s in counted.collect():
            x = g["guide_code"] ^ s["code"]
            mask = (x | x >> 1) & specificity.LOW_BITS
            if g["genome"] == s["genome"] and mask.bit_count() <= 4:
                out.append((g["genome"], g["guide_code"], s["code"], s["n"], mask, mask.bit_count()))
    return sorted(out)


def test_all_forms_find_the_same(spark, tables_of):
    guides, counted = tables_of
    wanted = plain(guides, counted)
    assert len(wanted) > 100
    for keys in ("slices", "pairs"):
        index = sites.sliced(counted, keys=keys)
        assert found(specificity.neighbours(guides, index, keys=keys)) == wanted
        for most in (40, 50_000):
            assert found(specificity.neighbours_in_blocks(guides, index, keys=keys, most=most)) == wanted
            assert found(specificity.neighbours(guides, index, keys=keys, hot=specificity.hot_slices(index, most))) == wanted
    assert found(specificity.neighbours(guides, sites.sliced(counted), max_broadcast=0, salt=3)) == wanted
    few = plain(guides.limit(0), counted)
    assert found(specificity.neighbours_in_blocks(guides.limit(0), sites.sliced(counted))) == few == []


def test_steps_of_the_kernel(spark, tables_of, monkeypatch):
    guides, counted = tables_of
    monkeypatch.setattr(specificity, "STEP_PAIRS", 10)
    assert found(specificity.neighbours_in_blocks(guides, sites.sliced(counted))) == plain(guides, counted)


def test_hot_slices_are_dealt_out(spark, tables_of):
    _, counted = tables_of
    index = sites.sliced(counted)
    hot, most = specificity.hot_slices(index, 40).cache(), 40
    assert 0 < hot.count() <= 5 * counted.count() / most
    key = ["genome", "slice_no", "slice_val"]
    dealt = index.join(hot, key, "left").groupBy(*key, F.pmod(F.hash("code"), F.coalesce("parts", F.lit(1)))).count()
    assert index.groupBy(*key).count().agg(F.max("count")).first()[0] > 4 * most and dealt.agg(F.max("count")).first()[0] <= 2 * most


def test_an_index_in_buckets_is_not_shuffled(spark, tables_of, tmp_path):
    guides, counted = tables_of
    sites.write_site_index(sites.sliced(counted), "neighbour_index", 8, str(tmp_path / "index"))
    try:
        plain_guides = spark.createDataFrame(guides.collect(), "genome string, guide_code long")
        plan = specificity.neighbours(plain_guides, spark.table("neighbour_index"), max_broadcast=0)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange ") == 1  # that of the guides
        assert found(specificity.neighbours(guides, spark.table("neighbour_index"), max_broadcast=0)) == plain(guides, counted)
    finally:
        spark.sql("DROP TABLE neighbour_index")


def test_the_index_is_never_broadcast_and_guides_only_up_to_their_rows(spark, tables_of):
    guides, counted = tables_of
    n = guides.count()
    plan = lambda most, **o: specificity.neighbours(guides, sites.sliced(counted, keys=o.get("keys", "slices")), max_broadcast=most, **o)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(5 * n) and "BroadcastHashJoin" not in plan(5 * n - 1)
    assert "BroadcastHashJoin" in plan(15 * n, keys="pairs") and "BroadcastHashJoin" not in plan(15 * n - 1, keys="pairs") and "BroadcastHashJoin" not in plan(10 * n, salt=3)


def test_verdicts_by_rounds(spark, tables_of, monkeypatch):
    guides, counted = tables_of
    index, seen = sites.sliced(counted), []
    whole = specificity.off_target_sums(specificity.neighbours(guides, index))
    score = {(r["genome"], r["guide_code"]): 10_000 / (100 + r["total"]) for r in whole.collect()}
    true = specificity.neighbours

    def counting(guides, *rest, **options):
        seen.append(guides.count())
        return true(guides, *rest, **options)

    monkeypatch.setattr(specificity, "neighbours", counting)
    for least in (75, 50, 99.9):
        seen.clear()
        got = {(r["genome"], r["guide_code"]): r["specific"] for r in specificity.specific_guides(guides, index, least).collect()}
        assert got == {(g["genome"], g["guide_code"]): score.get((g["genome"], g["guide_code"]), 100) >= least for g in guides.collect()}
        assert seen == sorted(seen, reverse=True) and seen[-1] < seen[0] == guides.count()  # those decided meet no more sites


def test_lists_of_genomes(spark, tmp_path):
    r = random.Random(3)
    rows = [(g, "".join(r.choices("ACGT", k=4))) for g in "ab" for _ in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one file
    try:
        fasta.write_sites(spark.createDataFrame(rows, "genome string, site string").repartition(5), str(tmp_path / "lists"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in "ab":
        files = sorted((tmp_path / f"lists/genome={g}").glob("part-*"))
        assert "".join(f.read_text() for f in files).split() == sorted(s for own, s in rows if own == g)
    assert len(list((tmp_path / "lists").glob("genome=*/part-*"))) > 2


def test_guides_without_a_vote(spark):
    guides = spark.createDataFrame([(1, "A" * 23), (2, None), (3, "acgt" * 6), (4, "ACGT"), (5, "X" * 23), (6, "")], "k int, sequence string")
    rbf = {"support_vectors": [[1, 0, 0, 0] * 20], "dual_coef": [1.0], "gamma": 0.1, "intercept": -0.5}
    assert {r["k"]: r["sgrnascorer"] for r in efficiency.svm_vote(guides, rbf).collect()} == {1: False, 2: None, 3: None, 4: None, 5: None, 6: None}
    none = guides.filter("k > 1")
    assert {r["sgrnascorer"] for r in efficiency.svm_vote(none, rbf).collect()} == {None}


def test_keyed_writes_read_the_buckets_they_touch(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "targets"), []
    make = lambda jobs: spark.createDataFrame([(j, 0) for j in jobs], "job_id string, target_id long")
    tables.write_targets(make([str(k) for k in range(200)]), path, buckets=64)
    true = tables.reread
    monkeypatch.setattr(tables, "reread", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or true(df, name))
    tables.write_targets(make(["7"]), path, buckets=64)
    filters = [x.split("]")[0] for x in plans[-1].split("PartitionFilters: [")[1:]]
    assert any("job_bucket" in x and "isnotnull" in x.lower() for x in filters)
    assert spark.read.parquet(path).count() == 200


def packed(spark, counted, most=7):
    """Counts as packed rows of at most `most` sites."""
    rows = {}
    for r in counted.collect():
        rows.setdefault((r["genome"], r["code"] % 5), []).append((r["code"], r["n"]))
    data = [(g, np.array([c for c, _ in part]).tobytes(), np.array([n for _, n in part]).tobytes()) for (g, _), own in rows.items() for i in range(0, len(own), most) for part in [own[i : i + most]]]
    return spark.createDataFrame(data, "genome string, codes binary, ns binary")


@pytest.mark.parametrize("step", [10, specificity.STEP_PAIRS])
def test_packed_forms_find_the_same(spark, tables_of, monkeypatch, step):
    guides, counted = tables_of
    monkeypatch.setattr(specificity, "STEP_PAIRS", step), monkeypatch.setattr(specificity, "GUIDES_A_ROW", 3)
    wanted, lying = plain(guides, counted), packed(spark, counted, 50)
    for keys in ("slices", "pairs"):
        index = sites.packed_index(lying, keys)
        assert found(specificity.neighbours(guides, lying, keys=keys)) == wanted
        assert found(specificity.neighbours(guides, lying, keys=keys, max_broadcast=0, salt=3)) == wanted
        assert found(specificity.neighbours(guides, index, keys=keys)) == wanted
        assert found(specificity.neighbours(guides, index, keys=keys, hot=specificity.hot_slices(index, 40))) == wanted
        assert found(specificity.neighbours_in_blocks(guides, lying, keys=keys, most=40)) == wanted
    rounds = [specificity.neighbours(guides, lying, only=k) for k in range(5)]
    assert sorted(r for part in rounds for r in found(part)) == wanted


def test_packed_index_holds_each_site_once_a_key(spark, tables_of):
    _, counted = tables_of
    for keys in ("slices", "pairs"):
        index = sites.packed_index(packed(spark, counted), keys)
        rows = [(r["genome"], r["slice_no"], r["slice_val"], c, n) for r in index.collect() for c, n in zip(np.frombuffer(r["codes"], dtype=np.int64).tolist(), np.frombuffer(r["ns"], dtype=np.int64).tolist(), strict=True)]
        assert sorted(rows) == sorted(tuple(r) for r in sites.index_of(counted, keys).collect())
        hist = {tuple(r)[:3]: r["n_sites"] for r in sites.slice_histogram(sites.index_of(counted, keys)).collect()}
        assert {tuple(r)[:3]: r["parts"] for r in specificity.hot_slices(index, 10).collect()} == {k: -(-n // 10) for k, n in hist.items() if n > 10}


def test_few_guides_meet_packed_sites_without_a_row_for_each_key(spark, tables_of):
    guides, counted = tables_of
    plan = specificity.neighbours(guides, packed(spark, counted))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("BroadcastHashJoin") == 1
