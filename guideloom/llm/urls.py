"""URL filters: host and path rules, and a list of URLs behind a blocked Bloom filter.

Native throughout. A rule fits its host and all subdomains if the path starts with the
rule's; the longest wins. URLs that no rule fits are looked up in a list of canonical
URLs: a blocked Bloom filter (one 64-bit block a key, four bits in it) passes all listed
URLs and a few others, and an exact hash join of what passed removes the others.

The filter is broadcast while it is within its stated size; beyond that its blocks are
shuffled and joined by their numbers, which spreads any number of listed URLs over tasks and
lets skewed ones be split at run time. The exact join follows in both cases.

Defined cases: a null URL or one without :// has an empty host and path, fits no rule and
is not listed; repeated rows give equal rows; an empty list blocks nothing; columns other
than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, UPPER, staged

#: Bits of the filter for each listed URL, and the greatest filter to broadcast.
BITS_PER_KEY, MAX_FILTER_BYTES = 16, 32 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without closing slashes, query without utm_ parameters; no scheme, no fragment. Null without a host."""
    query = F.regexp_extract(url, r"://[^/?#]*[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&", "")
    text = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), r"/+$", ""), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host_of(url) != "", text)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; null if none fits. rules: (verdict, host, path)."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered]
    pick = lambda values: F.coalesce(F.lit(None).cast("string"), *[F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)])
    return pick([h + p for _, h, p in ordered]), pick([v for v, _, _ in ordered])


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1))


def _mask(key: str) -> Column:
    """Four bits, each from six bits of a second hash."""
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(7, {key}), {s}) & 63L as int))" for s in (0, 6, 12, 18)))


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """(block, bits) of all keys; at most `blocks` rows, a power of two."""
    return keys.select(_block(F.col(column), blocks).alias("block"), _mask(column).alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("bits"))


def listed_flags(rows: DataFrame, listed: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """rows with a boolean column listed: whether the key is in the list (one column, `key`, distinct and not null)."""
    hit = listed.select(F.col(key), F.lit(True).alias("listed"))
    n = listed.count()
    blocks = 1 << max(0, (n * bits_per_key // 64 - 1)).bit_length()
    bits = bloom_filter(listed, key, blocks)
    if 16 * min(blocks, n) <= max_filter_bytes:
        bits = F.broadcast(bits)
    # rows without a key meet no block, and are dealt out if the filter is shuffled
    block = F.when(F.col(key).isNull(), -1 - F.monotonically_increasing_id()).otherwise(_block(F.col(key), blocks))
    probed = rows.withColumn("block", block).withColumn("mask", _mask(key)).join(bits, "block", "left")
    passes = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)) & F.col(key).isNotNull()
    probed = probed.withColumn("passes", passes).drop("block", "mask", "bits")
    sure = probed.filter("passes").drop("passes").join(hit, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return sure.unionByName(probed.filter("not passes").drop("passes").withColumn("listed", F.lit(False)))


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, listed. listed: a column canon of listed canonical URLs."""
    known = staged(listed.select("canon").filter(F.col("canon").isNotNull()).distinct(), "url-list")
    url = F.col(url_col)
    rows = listed_flags(pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canon")), known, "canon")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit(default))).alias("verdict"), "listed")
