"""Near-neighbour join of guides with sites, and the off-target score."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guideloom.functions.sequences import SITE, encode2bit
from guideloom.functions.windows import in_arrow
from guideloom.operators.sites import SLICES, key_values, keys_of, packed_index, slice_histogram, sliced
from guideloom.sources.staging import reread

#: Weight of a mismatch at each base, from the end far from the PAM (Hsu et al. 2013).
WEIGHTS = (0, 0, 0.014, 0, 0, 0.395, 0.317, 0, 0.389, 0.079, 0.445, 0.508, 0.613, 0.851, 0.732, 0.828, 0.615, 0.804, 0.685, 0.583)
LOW_BITS = 0x5555555555


def mismatch_mask(a: Column, b: Column) -> Column:
    """The low bit of each two-bit base that differs."""
    x = a.bitwiseXOR(b)
    return x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(LOW_BITS))


#: Rows of guides (one for each key and salt) that may be broadcast; beyond that both sides are shuffled by slice.
MAX_BROADCAST_ROWS = 500_000


def first_common_key(mask: Column, keys: str) -> Column:
    """The first key at which a guide and a site with these mismatches are equal: the one that keeps the pair."""
    stretches = keys_of(keys)
    first = F.lit(len(stretches))
    for k in reversed(range(len(stretches))):
        bits = sum(((1 << n) - 1) << low for low, n in stretches[k])
        first = F.when(mask.bitwiseAND(F.lit(bits)) == 0, k).otherwise(first)
    return first


def neighbours(guides: DataFrame, index: DataFrame, max_mismatches: int = 4, salt: int = 1, max_broadcast: int = MAX_BROADCAST_ROWS, keys: str = "slices", hot: DataFrame | None = None, only: int | None = None) -> DataFrame:
    """(genome, guide_code, code, n, mask, mismatches): all sites within max_mismatches of each guide, each once.

    Five slices and at most four mismatches leave a slice untouched, so an equi-join on
    (genome, slice) finds every pair; it is kept in its first equal slice only. guides:
    distinct (genome, guide_code). salt: parts into which each bucket of sites is dealt.
    hot: buckets that are dealt out beyond that, with their number of parts (see hot_slices); the others stay whole.
    keys: those that the index was built with; pairs of parts for genomes of many sites.
    index: rows of index_of; or packed_counts, against which few guides are held without a row for each key of a site; or packed_index.
    only: the pairs of this key alone."""
    if max_mismatches >= SLICES:
        raise ValueError("keys find at most four mismatches")
    if "codes" in index.columns:
        return _neighbours_of_packed(guides, index, max_mismatches, salt, max_broadcast, keys, hot, only)
    if only is not None:
        index = index.filter(F.col("slice_no") == only)
    left = sliced(guides.select("genome", "guide_code"), "guide_code", keys)
    on = ["genome", "slice_no", "slice_val"]
    if hot is not None:
        parts = F.broadcast(hot.select(*on, F.col("parts").alias("_parts")))
        several = F.coalesce("_parts", F.lit(1))
        left = left.join(parts, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0), several - 1))).drop("_parts")
        index = index.join(parts, on, "left").withColumn("part", F.pmod(F.hash("code"), several)).drop("_parts")
        on = [*on, "part"]
    elif salt > 1:
        left = left.withColumn("part", F.explode(F.array(*map(F.lit, range(salt)))))
        index = index.withColumn("part", F.pmod(F.hash("code"), F.lit(salt)))
        on = [*on, "part"]
    # the index is never broadcast, however small it is thought to be; guides are counted only up to what may be sent
    most = max_broadcast // (salt * len(keys_of(keys)))
    few = hot is None and most > 0 and guides.limit(most + 1).count() <= most
    left = F.broadcast(left) if few else left.hint("merge")
    met = left.join(index, on).withColumn("mask", mismatch_mask(F.col("guide_code"), F.col("code"))).withColumn("mismatches", F.bit_count("mask").cast("int"))
    return met.filter((F.col("mismatches") <= max_mismatches) & (first_common_key(F.col("mask"), keys) == F.col("slice_no"))).select("genome", "guide_code", "code", "n", "mask", "mismatches")


def hot_slices(index: DataFrame, most: int) -> DataFrame:
    """(genome, slice_no, slice_val, parts): the buckets of the index with more than `most` sites, and how many parts have that many each. No more rows than sites / most, so it may be broadcast where `most` is in proportion to a task."""
    packed = F.floor(F.length("codes") / 8) if "codes" in index.columns else None
    buckets = slice_histogram(index) if packed is None else index.groupBy("genome", "slice_no", "slice_val").agg(F.sum(packed).alias("n_sites"))
    return buckets.filter(F.col("n_sites") > most).select("genome", "slice_no", "slice_val", F.ceil(F.col("n_sites") / most).cast("int").alias("parts"))


#: Pairs that one step of the kernel holds.
STEP_PAIRS = 1 << 20


#: Guides in one row of a packed join.
GUIDES_A_ROW = 4096
NEAR = "genome string, guide_code long, code long, n long, mask long, mismatches int"


def _pairs(a: np.ndarray, b: np.ndarray, stretches: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b whose codes are equal in these stretches, about STEP_PAIRS at a time."""
    own, theirs = key_values(a, stretches), key_values(b, stretches)
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=1 << sum(bits for _, bits in stretches))
    starts, many = np.cumsum(counts) - counts, counts[theirs]
    at = np.flatnonzero(many)
    many, first = many[at], starts[theirs[at]]
    ends = np.cumsum(many)
    i = 0
    while i < len(at):
        before = ends[i] - many[i]
        j = max(i + 1, int(np.searchsorted(ends, before + STEP_PAIRS, side="right")))
        n = many[i:j]
        yield order[np.arange(ends[j - 1] - before) + np.repeat(first[i:j] - (ends[i:j] - n - before), n)], np.repeat(at[i:j], n)
        i = j


def _near(genome: str, a: np.ndarray, b: np.ndarray, ns: np.ndarray, numbers: Iterable[int], every: list, max_mismatches: int) -> Iterator[pa.RecordBatch]:
    """Near pairs of guides a and sites b, each in its first equal key, for the keys of these numbers."""
    masks, low = [sum(((1 << n) - 1) << at for at, n in stretches) for stretches in every], np.int64(LOW_BITS)
    for k in numbers:
        for of, at in _pairs(a, b, every[k]):
            x = a[of] ^ b[at]
            x = (x | x >> 1) & low
            near = np.flatnonzero(np.bitwise_count(x) <= max_mismatches)
            for earlier in masks[:k]:
                near = near[x[near] & earlier != 0]
            if len(near):
                of, at, x = of[near], at[near], x[near]
                yield pa.RecordBatch.from_arrays([pa.array([genome] * len(x), pa.string()), pa.array(a[of]), pa.array(b[at]), pa.array(ns[at]), pa.array(x), pa.array(np.bitwise_count(x).astype(np.int32))], names=["genome", "guide_code", "code", "n", "mask", "mismatches"])


def _neighbours_of_packed(guides: DataFrame, index: DataFrame, max_mismatches: int, salt: int, max_broadcast: int, keys: str, hot: DataFrame | None, only: int | None) -> DataFrame:
    """neighbours by arrays of codes: guides and sites of a row meet in numpy, and only near pairs leave the task."""
    every = keys_of(keys)
    most = max_broadcast // (salt * len(every))
    few = hot is None and most > 0 and guides.limit(most + 1).count() <= most
    keyed = "slice_no" in index.columns
    if few and not keyed:
        # no row for each key: a task holds the guides of a genome, and looks the keys of its sites up among theirs
        left, on = F.broadcast(guides.groupBy("genome").agg(F.collect_list("guide_code").alias("guide_codes"))), ["genome"]
    else:
        index = index if keyed else packed_index(index, keys)
        if only is not None:
            index = index.filter(F.col("slice_no") == only)
        left, on = sliced(guides.select("genome", "guide_code"), "guide_code", keys), ["genome", "slice_no", "slice_val"]
        if hot is not None or salt > 1:
            # rows of the index hold the sites of one key, and are dealt out whole
            several = F.lit(salt)
            if hot is not None:
                parts, several = F.broadcast(hot.select(*on, F.col("parts").alias("_parts"))), F.coalesce("_parts", F.lit(1))
                left, index = left.join(parts, on, "left"), index.join(parts, on, "left")
            left, index = left.withColumn("part", F.explode(F.sequence(F.lit(0), several - 1))).drop("_parts"), index.withColumn("part", F.pmod(F.hash("codes"), several)).drop("_parts")
            on = [*on, "part"]
        left = left.groupBy(*on).agg(F.collect_list("guide_code").alias("_all"))
        left = left.select(*on, F.explode(F.transform(F.sequence(F.lit(1), F.size("_all"), F.lit(GUIDES_A_ROW)), lambda i: F.slice("_all", i, GUIDES_A_ROW))).alias("guide_codes"))
        left = F.broadcast(left) if few else left.hint("merge")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                genome, codes, ns, number = (batch.column(c)[row].as_py() for c in ("genome", "codes", "ns", "number"))
                ours = batch.column("guide_codes")[row].values.to_numpy()
                yield from _near(genome, ours, np.frombuffer(codes, dtype=np.int64), np.frombuffer(ns, dtype=np.int64), range(len(every)) if number is None else [number], every, max_mismatches)

    number = F.col("slice_no") if "slice_no" in on else F.lit(only).cast("int")
    return in_arrow(left.join(index, on).select("genome", "guide_codes", "codes", "ns", number.alias("number")), compare, NEAR)


def neighbours_in_blocks(guides: DataFrame, index: DataFrame, max_mismatches: int = 4, keys: str = "slices", most: int = 50_000) -> DataFrame:
    """The same rows without a row for each candidate pair: guides and sites of a bucket meet as two arrays of codes, block by block, and only hits leave the task. Buckets with more than `most` sites are dealt out by hot_slices, so a task holds that many, and the guides of one bucket."""
    if max_mismatches >= SLICES:
        raise ValueError("keys find at most four mismatches")
    if "codes" in index.columns:
        index = index if "slice_no" in index.columns else packed_index(index, keys)
        return neighbours(guides, index, max_mismatches, keys=keys, hot=hot_slices(index, most))
    masks = [sum(((1 << n) - 1) << low for low, n in stretches) for stretches in keys_of(keys)]
    on = ["genome", "slice_no", "slice_val"]
    parts = F.broadcast(hot_slices(index, most).withColumnRenamed("parts", "_parts"))
    several = F.coalesce("_parts", F.lit(1))
    left = sliced(guides.select("genome", "guide_code"), "guide_code", keys).join(parts, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0), several - 1))).drop("_parts")
    right = index.select(*on, "code", "n").join(parts, on, "left").withColumn("part", F.pmod(F.hash("code"), several)).drop("_parts")

    def compare(ours: pa.Table, sites: pa.Table) -> pa.Table:
        a, b = ours.column("guide_code").to_numpy(), sites.column("code").to_numpy()
        rows, places, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        if len(a) and len(b):
            key, low = int(ours.column("slice_no")[0].as_py()), np.int64(LOW_BITS)
            step = max(1, STEP_PAIRS // len(b))
            for start in range(0, len(a), step):
                x = a[start : start + step, None] ^ b[None, :]
                x = (x | (x >> 1)) & low
                near = np.bitwise_count(x) <= max_mismatches
                for earlier in masks[:key]:
                    near &= (x & earlier) != 0
                of, at = np.nonzero(near)
                rows.append(of + start), places.append(at), found.append(x[of, at])
        of, at, mask = (pa.array(np.concatenate(v)) for v in (rows, places, found))
        hit, site = ours.take(of), sites.take(at)
        return pa.table({"genome": hit.column("genome"), "guide_code": hit.column("guide_code"), "code": site.column("code"), "n": site.column("n"), "mask": mask, "mismatches": pa.array(np.bitwise_count(mask.to_numpy()).astype(np.int32))})

    return left.groupBy(*on, "part").cogroup(right.groupBy(*on, "part")).applyInArrow(compare, "genome string, guide_code long, code long, n long, mask long, mismatches int")


def hit_score(places: tuple[int, ...]) -> float:
    """Risk of a site that differs from the guide at these bases (1 to 20), of 100."""
    m, score = len(places), 100.0
    for p in places:
        score *= 1 - WEIGHTS[p - 1]
    if m > 1:
        mean = (places[-1] - places[0]) / (m - 1)
        score /= (SITE - 1 - mean) / (SITE - 1) * 4 + 1
    return score / m**2


def hit_table(spark: SparkSession, max_mismatches: int = 4) -> DataFrame:
    """(mask, hit) of every way to differ at up to four bases: 6 195 rows at most."""
    rows = [(sum(1 << 2 * (SITE - p) for p in places), hit_score(places)) for m in range(1, max_mismatches + 1) for places in combinations(range(1, SITE + 1), m)]
    return spark.createDataFrame(rows, "mask long, hit double")


def off_target_sums(met: DataFrame, max_mismatches: int = 4) -> DataFrame:
    """(genome, guide_code, n_exact, n_hits, total) of the neighbours."""
    scored = met.join(F.broadcast(hit_table(met.sparkSession, max_mismatches)), "mask", "left")
    exact = F.col("mismatches") == 0
    return scored.groupBy("genome", "guide_code").agg(F.sum(F.when(exact, F.col("n")).otherwise(0)).alias("n_exact"), F.sum(F.when(exact, 0).otherwise(F.col("n"))).alias("n_hits"), F.sum(F.when(exact, 0.0).otherwise(F.col("hit") * F.col("n"))).alias("total"))


def with_genome(targets: DataFrame, jobs: DataFrame) -> DataFrame:
    """Targets with the genome of their job; those of a missing job are left out."""
    return targets.join(jobs.select("job_id", "genome"), "job_id")


def orphans(targets: DataFrame, jobs: DataFrame) -> DataFrame:
    return targets.join(jobs.select("job_id"), "job_id", "left_anti")


def score_specificity(targets: DataFrame, jobs: DataFrame, index: DataFrame, max_mismatches: int = 4, consensus: DataFrame | None = None, salt: int = 1, keys: str = "slices") -> DataFrame:
    """(job_id, target_id, n_exact, score): 100 without a near site; null if the genome has no index.

    Equal guides of one genome are searched once. consensus: score only the efficient guides in it."""
    if consensus is not None:
        targets = targets.join(consensus.filter(F.col("efficient")).select("job_id", "target_id"), ["job_id", "target_id"], "left_semi")
    ours = with_genome(targets, jobs).withColumn("guide_code", encode2bit(F.substring("sequence", 1, SITE)))
    sums = off_target_sums(neighbours(ours.select("genome", "guide_code").distinct(), index, max_mismatches, salt, keys=keys), max_mismatches)
    known = index.select("genome").distinct().withColumn("indexed", F.lit(True))
    out = ours.join(sums, ["genome", "guide_code"], "left").join(known, "genome", "left")
    score = F.when(F.col("indexed"), 100.0 * 100.0 / (100.0 + F.coalesce("total", F.lit(0.0))))
    return out.select("job_id", "target_id", F.coalesce("n_exact", F.lit(0)).alias("n_exact"), score.alias("score"))


def specific_guides(guides: DataFrame, index: DataFrame, min_score: float = 75, max_mismatches: int = 4) -> DataFrame:
    """(genome, guide_code, specific): whether the whole score is min_score at least. guides: distinct (genome, guide_code).

    One round a slice: each finds the near sites whose first equal slice it is, and guides whose sum is already too large leave, so that later rounds meet fewer pairs. The verdict is that of the whole sum, as sums only grow. A genome without sites has only specific guides; see score_specificity for those without an index."""
    most = 100.0 * (100.0 / min_score - 1)
    rows = guides.select("genome", "guide_code", F.lit(0.0).alias("total"))
    done = []
    for k in range(SLICES):
        found = off_target_sums(neighbours(rows, index, max_mismatches, only=k), max_mismatches).select("genome", "guide_code", F.col("total").alias("more"))
        rows = reread(rows.join(found, ["genome", "guide_code"], "left").select("genome", "guide_code", (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total")), "undecided")
        done.append(rows.filter(F.col("total") > most).select("genome", "guide_code", F.lit(False).alias("specific")))
        rows = rows.filter(F.col("total") <= most)
    return reduce(DataFrame.unionByName, done, rows.select("genome", "guide_code", F.lit(True).alias("specific")))
