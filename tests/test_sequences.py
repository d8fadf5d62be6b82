import random

import pytest
from pyspark.sql import functions as F

from guideloom.functions import sequences, votes
from guideloom.operators import efficiency, sites, specificity, targets

GOLDEN = "ATCGATCGATCGATCGATCGAGGATCGATCGATCGATCGATCGTGGCCAATCGATCGATCGATCGATCG"


def rc(s):
    return s.translate(str.maketrans(sequences.IUPAC, sequences.IUPAC_COMPLEMENT))[::-1]


def dna(n, seed, letters="ACGT"):
    return "".join(random.Random(seed).choices(letters, k=n))


def brute_guides(seq):
    found = []
    for strand in "+-":
        for s in range(len(seq) - 22):
            p = seq[s : s + 23]
            if set(p) <= set("ACGT") and (p.endswith("GG") if strand == "+" else p.startswith("CC")):
                found.append((p if strand == "+" else rc(p), s, strand))
    seen = [g for g, _, _ in found]
    return [(i, g, 1, s, s + 23, strand) for i, (g, s, strand) in enumerate(x for x in found if seen.count(x[0]) == 1)]


def brute_sites(seq, reverse_slice):
    out = []
    for s in range(len(seq) - 22):
        p = seq[s : s + 23]
        if set(p) <= set("ACGT"):
            if p[0] in "ACG" and p[21] in "AG" and p[22] == "G":
                out.append(p[:20])
            if p[0] == "C" and p[1] in "CT" and p[22] in "TGC":
                out.append(rc(p[:20]) if reverse_slice == "reference" else rc(p)[:20])
    return sorted(out)


def jobs_of(spark, seqs):
    return spark.createDataFrame(list(enumerate(seqs)), "job_id long, sequence string")


def rows_by_job(df):
    out = {}
    for r in df.orderBy("job_id", "target_id").collect():
        out.setdefault(r["job_id"], []).append(tuple(r)[1:])
    return out


def test_golden_sample(spark):
    rows = rows_by_job(targets.design_guides(jobs_of(spark, [GOLDEN])))[0]
    assert rows == [(0, "ATCGATCGATCGATCGATCGAGG", 1, 0, 23, "+"), (1, "ATCGATCGATCGATCGATCGTGG", 1, 23, 46, "+"), (2, "CGATCGATCGATCGATCGATTGG", 1, 46, 69, "-")]
    contig = spark.createDataFrame([("g", "c", GOLDEN)], "genome string, contig string, seq string")
    for mode, minus in (("reference", "TCGATCGATCGATCGATTGG"), ("protospacer", "CGATCGATCGATCGATCGAT")):
        found = [r["site"] for r in sites.extract_offtargets(sites.chunk_contigs(contig), mode).collect()]
        assert minus in found and sorted(found) == brute_sites(GOLDEN, mode)


def test_guides_as_by_brute_force(spark):
    seqs = ["", "A" * 22, "A" * 21 + "GG", GOLDEN.lower(), dna(900, 1), dna(3000, 2), dna(500, 3, "ACGTN"), dna(260, 4, "CG"), "CC" + "A" * 21 + "T" + rc("CC" + "A" * 21), None]
    expected = {k: g for k, s in enumerate(seqs) if (g := brute_guides(s or ""))}
    assert rows_by_job(targets.design_guides(jobs_of(spark, seqs))) == expected
    assert rows_by_job(targets.design_guides(jobs_of(spark, seqs), block=100)) == expected
    assert rows_by_job(targets.design_guides(jobs_of(spark, seqs), block=None)) == expected


def test_chunks_hold_each_start_once(spark):
    seqs = ["", "ACGT", dna(1000, 5), dna(1001, 6, "ACGTN"), dna(77, 7)]
    contigs = spark.createDataFrame([("g", str(k), s) for k, s in enumerate(seqs)], "genome string, contig string, seq string")
    for mode in ("reference", "protospacer"):
        for size in (23, 100, 10**6):
            found = sites.extract_offtargets(sites.chunk_contigs(contigs, size), mode).collect()
            for k, s in enumerate(seqs):
                assert sorted(r["site"] for r in found if r["contig"] == str(k)) == brute_sites(s, mode)
    with pytest.raises(ValueError):
        sites.extract_offtargets(contigs, "other")


def test_codes_and_complements(spark):
    words = [dna(20, k) for k in range(50)] + ["A" * 20, "T" * 20]
    df = spark.createDataFrame([(w,) for w in [*words, "ACGT", "N" * 20, "RYKMnswACGTacgt-"]], "s string")
    rows = df.select("s", sequences.encode2bit(F.col("s")).alias("c"), sequences.decode2bit(sequences.encode2bit(F.col("s"))).alias("d"), sequences.reverse_complement(F.col("s")).alias("r"), sequences.reverse_complement(sequences.reverse_complement(F.col("s"))).alias("rr")).collect()
    for r in rows:
        assert r["r"] == rc(r["s"]) and r["rr"] == r["s"]
        if r["s"] in words:
            assert r["d"] == r["s"] and r["c"] == int(r["s"].translate(str.maketrans("ACGT", "0123")), 4)
        else:
            assert r["c"] is None
    blank = spark.range(1).select(sequences.normalise_sequence(F.lit("a C\r\ng\rt \n")).alias("a"), sequences.normalise_sequence(F.lit("ac"), upper=True).alias("b")).first()
    assert tuple(blank) == ("aCgt", "AC")


def test_validation(spark):
    seqs = ["", None, "A" * 10, "A" * 11, "ACGN", "acgt"]
    accepted, rejected = targets.validate_jobs(jobs_of(spark, seqs), max_length=10)
    assert [r["job_id"] for r in accepted.collect()] == [2, 5]
    assert {r["job_id"]: r["reject_reason"] for r in rejected.collect()} == {0: "empty", 1: "empty", 3: "too long", 4: "alphabet"}
    rows = spark.createDataFrame([("ACGT", "GCA_000482205.1"), ("ACGT", "GXX_1"), ("ACGT", None)], "sequence string, genome string")
    assert [r["genome"] for r in targets.validate_jobs(rows, accession_col="genome")[1].collect()] == ["GXX_1", None]


@pytest.fixture(scope="module")
def near(spark):
    base = dna(20, 11)
    change = lambda *at: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i + 1 in at else c for i, c in enumerate(base))
    rows = [("g", change(), 2), ("g", change(20), 1), ("g", change(1, 5, 9, 13), 3), ("g", change(1, 5, 9, 13, 17), 1), ("h", change(1), 1), ("g", change(1, 20), 1)]
    return base, spark.createDataFrame(rows, "genome string, site string, n long").select("genome", sequences.encode2bit(F.col("site")).alias("code"), "n")


def test_neighbours(spark, near):
    base, counted = near
    index = sites.sliced(counted)
    guides = spark.createDataFrame([("g", base), ("h", base), ("none", base)], "genome string, site string").select("genome", sequences.encode2bit(F.col("site")).alias("guide_code"))
    for salt in (1, 3):
        found = sorted((r["genome"], r["mismatches"], r["n"]) for r in specificity.neighbours(guides, index, salt=salt).collect())
        assert found == [("g", 0, 2), ("g", 1, 1), ("g", 2, 1), ("g", 4, 3), ("h", 1, 1)]
    with pytest.raises(ValueError):
        specificity.neighbours(guides, index, 5)


def test_slice_join_equals_brute_force(spark):
    r = random.Random(5)
    stems = [dna(20, 100 + k) for k in range(6)]
    words = list({"".join(c if r.random() > 0.2 else r.choice("ACGT") for c in r.choice(stems)) for _ in range(250)})
    coded = spark.createDataFrame([("g", w) for w in words], "genome string, site string").select("genome", sequences.encode2bit(F.col("site")).alias("code"), F.lit(1).alias("n"))
    met = specificity.neighbours(coded.select("genome", F.col("code").alias("guide_code")), sites.sliced(coded)).count()
    assert met == sum(sum(a != b for a, b in zip(x, y)) <= 4 for x in words for y in words)


def test_scores(spark, near):
    assert specificity.hit_score((20,)) == pytest.approx(41.7) and specificity.hit_score((1, 20)) == pytest.approx(10.425) and specificity.hit_score((1,)) == 100
    assert specificity.hit_table(spark).count() == 6195
    base, counted = near
    index = sites.sliced(counted)
    jobs = spark.createDataFrame([(1, "g"), (2, "h"), (3, "none"), (4, "g")], "job_id long, genome string")
    rows = [(j, 0, base + "AGG") for j in (1, 2, 3)] + [(4, 0, "A" * 23), (9, 0, base + "AGG")]
    scored = {r["job_id"]: (r["n_exact"], r["score"]) for r in specificity.score_specificity(spark.createDataFrame(rows, "job_id long, target_id long, sequence string"), jobs, index).collect()}
    total = specificity.hit_score((20,)) + specificity.hit_score((1, 20)) + 3 * specificity.hit_score((1, 5, 9, 13))
    assert scored == {1: (2, pytest.approx(10000 / (100 + total))), 2: (0, pytest.approx(50)), 3: (0, None), 4: (0, pytest.approx(100))}


def test_votes(spark):
    good = votes.SCAFFOLD
    line = lambda energy, folded=True: ("." * 28 + "((((....))))...))))" + "." * 21 + "((((....))))" + "(((((((...)))))))..." if folded else "." * 100) + f" ({energy})"
    cases = [(line("-30.0"), True), (line("-30.1"), False), (line(" -9.50"), True), (line("-18.0", False), False), (line("-17.9", False), True), (line("x"), False), ("", False), (None, False)]
    got = [r[0] for r in spark.createDataFrame([(k, a) for k, (a, _) in enumerate(cases)], "k long, a string").orderBy("k").select(votes.fold_verdict(F.col("a"))).collect()]
    assert got == [b for _, b in cases]
    seqs = ["A" * n + "C" * (23 - n) for n in (4, 5, 14, 15)]
    assert [r[0] for r in spark.createDataFrame(list(enumerate(seqs)), "k long, s string").orderBy("k").select(votes.at_in_range(F.col("s"))).collect()] == [False, True, True, False]
    guide = "TACGTACGTACGTACGTACGAGG"
    row = spark.createDataFrame([(guide, "1,0,1", "")], "s string, c string, e string").select(votes.fold_eligible(F.col("s")), votes.chopchop(F.col("s")), votes.fold_input(F.col("s")), votes.efficient(F.col("c")), votes.efficient(F.col("e")), votes.accepted_by(F.col("c"))).first()
    assert tuple(row) == (False, True, "G" + guide[1:20] + good, True, None, "chopchop sgrnascorer")


def test_svm_linear_and_rbf_agree_with_numpy(spark):
    import numpy as np

    seqs = [dna(23, k) for k in range(40)] + ["NKMRYSWBVHD" + "A" * 12]
    guides = spark.createDataFrame(list(enumerate(seqs)), "k long, sequence string")
    x = np.array([[int(b) for c in s[:20] for b in votes.ONE_HOT[c]] for s in seqs])
    w = np.random.default_rng(0).normal(size=80)
    linear = [r["sgrnascorer"] for r in efficiency.svm_vote(guides, {"weights": w.tolist(), "intercept": 0.1}).orderBy("k").collect()]
    assert linear == (x @ w + 0.1 >= 0).tolist()
    sv, coef = x[:9] + 0.0, np.linspace(-1, 1, 9)
    rbf = [r["sgrnascorer"] for r in efficiency.svm_vote(guides, {"support_vectors": sv.tolist(), "dual_coef": coef.tolist(), "gamma": 0.03, "intercept": 0.01}).orderBy("k").collect()]
    assert rbf == (np.exp(-0.03 * ((x[:, None] - sv[None]) ** 2).sum(2)) @ coef + 0.01 >= 0).tolist()
    assert efficiency.score_with(guides, lambda b: b[["k"]], "k long").count() == len(seqs)


def test_counted_codes_are_those_of_the_sites(spark):
    """Over several steps, genomes (one of them null) and tasks, with sites that repeat."""
    seqs = [("g", dna(2000, 5)), ("h", dna(1001, 6, "ACGTN")), ("g", dna(2000, 5)), ("h", "CC" + "A" * 60 + "GG"), (None, dna(300, 7)), ("g", ""), ("g", None), ("h", "acgg" * 20), ("g", "\u00e9" * 30 + dna(90, 8))]
    contigs = spark.createDataFrame([(g, str(k), s) for k, (g, s) in enumerate(seqs)], "genome string, contig string, seq string").repartition(3)
    for mode in ("reference", "protospacer"):
        wanted = {}
        for g, s in seqs:
            for site in brute_sites(s or "", mode):
                key = (g, sum("ACGT".index(b) << 2 * (19 - i) for i, b in enumerate(site)))
                wanted[key] = (site, wanted.get(key, (site, 0))[1] + 1)
        found = sites.with_letters(sites.count_sites(sites.chunk_contigs(contigs, 100), mode)).collect()
        assert {(r["genome"], r["code"]): (r["site"], r["n"]) for r in found} == wanted and len(found) == len(wanted)
