"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Steps: sizes of documents and sources (partial aggregation, so a hot source costs no more
than a small one); the water level, raised round by round while sources that reach their
cap are set to it and their excess is shared again by weight; then, for each source, the
whole repetitions of all its documents and one cut in a seeded order of its documents
below which a document is taken once more. Only the documents of one bucket for each
source, the bucket in which the cut lies, are ever ordered.

Defined cases: a null or empty text has size 0 and takes nothing; null sources are one
source, the last; rows that share an id, or have none, are drawn by their texts too, and
only those that share both are taken or left together; an empty table gives
an empty mix; columns other than the three named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, staged

#: Documents that one task orders at most, about.
BUCKET_ROWS = 4096


def drawn(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key alone: 52 bits of an MD5, which other engines have too."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_draws(rows: DataFrame, seed: int) -> DataFrame:
    """rows (doc_id, digest, ...) with a draw for each: by the id, or where rows share an id, or have none, by id and text."""
    shared = staged(rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select("doc_id"), "mix-shared-ids")
    if not shared.limit(1).count():
        return rows.withColumn("draw", drawn(seed, F.col("doc_id"))).drop("digest")
    r, s = rows.alias("r"), shared.withColumn("again", F.lit(True)).alias("s")
    joined = r.join(s, F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")), "left")
    own = F.concat(F.coalesce(F.col("r.doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("digest").cast("string"))
    draw = F.when(F.col("again"), drawn(seed, own)).otherwise(drawn(seed, F.col("r.doc_id")))
    return joined.select("r.*", draw.alias("draw")).drop("digest")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """Weights that repeat along the sources in code point order, null last. One row a source: the only ordered table, as long as the list of sources."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.select("source", F.element_at(F.array(*map(F.lit, map(float, cycle))), (place % len(cycle) + 1).cast("int")).alias("weight"))


def water_level(sources: DataFrame, total: float) -> float | None:
    """The level at which the sum of least(cap, level * weight) is total; None if all caps together hold no more than total.

    Each round is one aggregation to two numbers. The level only rises, and each round
    but the last sets at least one more source to its cap."""
    level = 0.0
    while True:
        capped = F.col("cap") <= F.col("weight") * level
        full, weight = sources.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not weight:
            return None
        raised = max(level, (total - full) / weight)
        if raised == level:
            return level
        level = raised


def plan_mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0, cycle: tuple[float, ...] = (5, 2, 1), seed: int = 17, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with their sizes, plan of one row a source).

    The plan has source, source_size, target, whole (repetitions of every document) and
    cut (documents with draw <= cut are taken once more). weights: (source, weight), or
    else the cycle along the sources."""
    sized = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), _digest(text_col)), "mix-sizes")
    sized = with_draws(sized, seed)
    totals = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-totals")
    weights = cyclic_weights(totals, cycle) if weights is None else weights.select("source", F.col("weight").cast("double"))
    t, w = totals.alias("t"), weights.alias("w")
    sources = staged(t.join(w, F.col("t.source").eqNullSafe(F.col("w.source"))).select("t.source", "source_size", "n", (F.col("source_size") * float(max_epochs)).alias("cap"), "weight"), "mix-sources")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, total)
    target = F.col("cap") if level is None else F.least("cap", F.col("weight") * level)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    targets = sources.withColumn("target", target).withColumn("whole", whole.cast("int")).withColumn("rest", F.col("target") - F.col("whole") * size).withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS))
    targets = staged(targets, "mix-targets")

    # the bucket of the draw in which the rest of each source runs out
    s, g = sized.alias("s"), targets.alias("g")
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    bucket = F.floor(F.col("draw") * F.col("buckets"))
    filled = s.join(g, same).groupBy("s.source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    crossed = staged(filled.withColumn("upto", upto).filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest"))).select("source", "bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("left")), "mix-crossed")

    c = crossed.alias("c")
    inside = s.join(g.select("source", "buckets"), same).join(c, F.col("s.source").eqNullSafe(F.col("c.source")) & (bucket == F.col("c.bucket"))).groupBy("s.source", "c.bucket", "left", "draw").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source", "bucket").orderBy("draw"))
    taken = inside.withColumn("running", running).filter(F.col("running") - F.col("words") / 2 <= F.col("left"))
    cut = taken.groupBy("source").agg(F.max("draw").alias("inside_cut")).alias("i")
    plan = g.join(c, F.col("g.source").eqNullSafe(F.col("c.source")), "left").join(cut, F.col("g.source").eqNullSafe(F.col("i.source")), "left")
    before = F.col("c.bucket") / F.col("buckets") - F.lit(2.0**-53)  # all buckets before the crossed one are taken
    plan = plan.select("g.source", "source_size", "target", "whole", F.when(F.col("rest") <= 0, F.lit(-1.0)).otherwise(F.coalesce("inside_cut", before, F.lit(1.0))).alias("cut"))
    return sized, staged(plan, "mix-plan")


def _digest(text_col: str) -> Column:
    return F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("digest")


def _copies() -> Column:
    return F.col("whole") + (F.col("draw") <= F.col("cut")).cast("int")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies, taken. Options: those of plan_mix."""
    sized, plan = plan_mix(docs, **options)
    s, p = sized.alias("s"), plan.alias("p")
    return s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("doc_id", "s.source", "size", "source_size", "target", _copies().alias("copies"), (F.col("size") * _copies()).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The documents themselves, each row as often as the mix takes it; columns as in docs."""
    _, plan = plan_mix(docs, seed=seed, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    rows = with_draws(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("of"), _digest(text_col)), seed)
    out = rows.join(plan, F.col("of").eqNullSafe(F.col("source"))).filter(_copies() > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1), _copies()))).select("row.*")
