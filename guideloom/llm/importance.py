"""Importance resampling towards a target distribution, with overlap chunking of long texts.

Hashed runs of 1 to n words are counted over all documents and over the target's texts. A
bucket's gain is the logarithm of the ratio of its (smoothed) shares; a document's weight is
the sum of the gains of its runs. Gumbel noise drawn from the id makes the highest scores a
sample without replacement that is proportional to the exponents of the weights.

Texts beyond `long_bytes` are cut into chunks of `chunk_words` words at word boundaries. A
chunk carries the n - 1 words that follow it and owns the runs that start in its own words,
so no run is lost or counted twice. Chunks are dealt out over all tasks whatever text they
come from; their counts and weights are summed by document. A text that is not long is one
chunk and needs no shuffle.

What reaches the driver has a bound: counts of `buckets` buckets, and one number for each
partition of the scores. Ranks come from a range-partitioned sort, never from one task.

Defined cases: a null or empty text has no runs, weight 0, and is never drawn; a null id draws
as an empty one; ties go to the smaller id (null last); rows that share id and text are each
judged and drawn on their own; an empty target has equal shares; a single word longer than a
chunk's bytes stays whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytes import mapped, raw_of, table_of, text_array
from .shared import flat_words, in_arrow, slices, staged, sums, texts_of

#: Words are runs of digits, letters and anything beyond ASCII.
WORDS = table_of("0123456789abcdefghijklmnopqrstuvwxyz")
LONG_BYTES, CHUNK_WORDS = 1 << 19, 1 << 16


def chunks_of(text: pa.Array, n: int, size: int) -> tuple[pa.Array, np.ndarray]:
    """One (mapped) text cut at word boundaries, and the words that each chunk owns. Each chunk but the last carries n - 1 more."""
    raw, _ = raw_of(text)
    word = np.concatenate([[False], raw != 32, [False]])
    starts, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    first = np.arange(0, max(len(starts), 1), size)
    owned = np.minimum(size, len(starts) - first)
    if not len(starts):
        return pa.array([""]), owned
    last = np.minimum(first + size + n - 1, len(starts)) - 1
    cuts = [raw[a:b] for a, b in zip(starts[first], ends[last], strict=True)]
    return text_array(np.concatenate(cuts), np.concatenate([[0], np.cumsum([len(c) for c in cuts])])), owned


def runs(texts: pa.Array, owned: np.ndarray, n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all runs of k words, for k from 1 to n, that start in the first `owned` words of their row. texts are mapped."""
    row, words = flat_words(texts)
    if not len(row):
        return
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    spelled = [w.encode() for w in words.dictionary.to_pylist()]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    starts = np.flatnonzero(place < owned[row])
    same, sum_ = code, np.fromiter(map(zlib.crc32, spelled), dtype=np.int64, count=len(spelled))
    for k in range(1, n + 1):
        if k > 1:
            starts = starts[starts + k - 1 < len(row)]
            starts = starts[row[starts + k - 1] == row[starts]]
            longer, inverse = np.unique(same[starts] * len(spelled) + code[starts + k - 1], return_inverse=True)
            sum_ = np.fromiter((zlib.crc32(b" " + spelled[x % len(spelled)], int(sum_[x // len(spelled)])) for x in longer.tolist()), dtype=np.int64, count=len(longer))
            same = np.zeros(len(row), dtype=np.int64)
            same[starts] = inverse
        yield row[starts], sum_[same[starts]] % buckets


def _rows(docs: DataFrame, text: str, ids: Column | None) -> DataFrame:
    """_id, _digest, _chunk, _owned (null: all words), _text. Long texts are still whole."""
    text = F.col(text).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0))
    return docs.select((F.lit(None).cast("string") if ids is None else ids).alias("_id"), F.xxhash64(text, size).alias("_digest"), F.lit(0).alias("_chunk"), F.lit(None).cast("long").alias("_owned"), text.alias("_text"))


def _parts(rows: DataFrame, n: int, long_bytes: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(rows of texts that are not long, dealt chunks of the long ones)."""
    is_long = F.coalesce(F.octet_length("_text"), F.lit(0)) > long_bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                texts, owned = chunks_of(mapped(texts_of(one, "_text"), WORDS), n, size)
                same = pa.array(np.zeros(len(owned), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([one.column("_id").take(same), one.column("_digest").take(same), pa.array(np.arange(len(owned), dtype=np.int32)), pa.array(owned, type=pa.int64()), texts], names=one.schema.names)

    return rows.filter(~is_long), in_arrow(rows.filter(is_long), cut, rows.schema).repartition(F.col("_id"), F.col("_digest"), F.col("_chunk"))


def _owned(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_owned").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def bucket_counts(docs: DataFrame, n: int, buckets: int, text_col: str = "text", long_bytes: int = LONG_BYTES, chunk_words: int = CHUNK_WORDS) -> np.ndarray:
    """How often runs fall into each bucket, over all texts. A task hands on its sums, at most a row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches, "_text"):
            for _, bucket in runs(mapped(texts_of(batch, "_text"), WORDS), _owned(batch), n, buckets):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    short, long = (in_arrow(part, count, "bucket long, n long") for part in _parts(_rows(docs, text_col, None), n, long_bytes, chunk_words))
    found, out = short.unionByName(long).groupBy("bucket").agg(F.sum("n").alias("n")).toPandas(), np.zeros(buckets, dtype=np.int64)
    out[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) of each bucket."""
    all_source, all_target, buckets = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weights(docs: DataFrame, gains: np.ndarray, n: int, text_col: str = "text", id_col: str = "doc_id", long_bytes: int = LONG_BYTES, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, digest, n_words, n_features, weight: one row a document."""
    rows = _rows(docs, text_col, F.col(id_col))
    kind = rows.schema["_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            m = batch.num_rows
            words, features, weight = (np.zeros(m, dtype=np.int64) for _ in range(3))
            for k, (row, bucket) in enumerate(runs(mapped(texts_of(batch, "_text"), WORDS), _owned(batch), n, len(gains))):
                each = sums(row, None, m)
                words, features, weight = words if k else each, features + each, weight + sums(row, gains[bucket], m)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_digest"), batch.column("_chunk"), pa.array(words), pa.array(features), pa.array(weight)], names=["doc_id", "digest", "chunk", "n_words", "n_features", "weight"])

    short, long = (in_arrow(part, weigh, f"doc_id {kind}, digest long, chunk int, n_words long, n_features long, weight long") for part in _parts(rows, n, long_bytes, chunk_words))
    # rows that share id and text have equal chunks: their sums are divided by their number
    summed = long.groupBy("doc_id", "digest").agg(F.count(F.when(F.col("chunk") == 0, 1)).alias("times"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")])
    each = summed.select("doc_id", "digest", *[F.expr(f"{c} div times").alias(c) for c in ("n_words", "n_features", "weight")], F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")
    return short.drop("chunk").unionByName(each)


def noise(ids: Column, seed: str) -> Column:
    """floor(1000 times a Gumbel number) that depends on seed and id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """rows with their rank by score (ties to the smaller id) if it is among the first percent % of all rows, else null."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "digest"]
    placed = staged(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "importance-order")
    part, here = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(map(tuple, placed.groupBy(part.cast("int").alias("part")).count().collect()))  # a row for each partition of the sort
    before, total = [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "part int, before long")
    rank = F.col("before") + here + 1
    found = placed.withColumn("part", part.cast("int")).join(F.broadcast(offsets), "part")
    return found.withColumn("rank", F.when(rank <= percent * total // 100, rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", **options) -> DataFrame:
    """One row a document: doc_id, digest (of its text), n_words, n_features, weight, score, and rank if it is drawn. Of the documents with at least min_words words, percent % are drawn. options: long_bytes, chunk_words."""
    gains = gains_of(bucket_counts(docs, n, buckets, text_col, **options), bucket_counts(target, n, buckets, target_text, **options))
    scored = weights(docs, gains, n, text_col, id_col, **options).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = staged(scored, "importance-scores")
    return ranked(scored.filter(F.col("n_words") >= min_words), percent).unionByName(scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that resample draws, columns as in docs. Rows that share id and text come together, also where the last rank falls among them."""
    drawn = resample(docs, target, id_col=id_col, text_col=text_col, **options).filter("rank is not null").select(F.col("doc_id").alias("_drawn"), F.col("digest").alias("_digest"))
    text = F.col(text_col).cast("string")
    digest = F.xxhash64(text, F.coalesce(F.octet_length(text), F.lit(0)))
    return docs.join(drawn, docs[id_col].eqNullSafe(drawn["_drawn"]) & (digest == drawn["_digest"]), "left_semi")
