"""Staging in the shared folder, and vectorised helpers for words of texts in Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words of every contract that splits on ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Words whose ids a worker keeps, and bytes of text that one step takes.
MAX_WORDS, STEP_BYTES = 100_000, 1 << 20
#: Bound of the bytes that Spark hands to a worker at once; a longer row comes alone.
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. Where it is unset, a temporary one in local mode; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def in_arrow(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """rows.mapInArrow(run, schema). Batches are bounded by their bytes, as ten thousand long texts would not fit a worker; a bound that the session has set stays."""
    conf = rows.sparkSession.conf
    if BATCH_BOUND not in conf.getAll:
        conf.set(BATCH_BOUND, BATCH_BYTES)
    return rows.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has at most `most` bytes of text, or one row: whole texts, bounded memory. At the end Arrow's free memory is given back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()  # workers live on and serve other stages


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def ascii_lower(texts: pa.Array) -> pa.Array:
    """Lower-case A-Z and nothing else, on the bytes of all texts at once."""
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    raw = np.frombuffer(data, dtype=np.uint8)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    return pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(low)], offset=texts.offset)


def flat_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Row of each word and the words as a dictionary array, in order."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    return row[full.to_numpy(zero_copy_only=False)], flat.filter(full).dictionary_encode()


def sums(row: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    """Sum of values, or count, for each of n rows."""
    if values is None:
        return np.bincount(row, minlength=n).astype(np.int64)
    return np.bincount(row, weights=values, minlength=n).astype(np.int64)


def dense(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 for equal keys."""
    return np.unique(keys, return_inverse=True)[1]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges [start, start + length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def extended(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The array with more written behind its used part; doubled when it is full."""
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.zeros(max(used, len(more), 1 << 12), dtype=array.dtype)])
    array[used : used + len(more)] = more
    return array


class WordTokens:
    """Token ids of words that a worker has met, forgotten when there are too many: bounded memory, the same ids."""

    def __init__(self, encode, most: int = MAX_WORDS):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.lengths, self.ids = (np.zeros(0, dtype=t) for t in (np.int32, np.int32, np.int32))
        self.used = 0

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length) of each word's ids in the third array."""
        known = words.to_pylist()
        if len(self.place) + len(known) > self.most:
            self.forget()
        get = self.place.get
        at = np.fromiter((get(w, -1) for w in known), dtype=np.int64, count=len(known))
        if len(missing := np.flatnonzero(at < 0)):
            new = [known[i] for i in missing]
            lengths, ids = self.encode(new)
            first = len(self.place)
            at[missing] = np.arange(first, first + len(new))
            self.place.update(zip(new, range(first, first + len(new)), strict=True))
            self.starts = extended(self.starts, first, self.used + np.cumsum(lengths) - lengths)
            self.lengths, self.ids = extended(self.lengths, first, lengths), extended(self.ids, self.used, ids)
            self.used += len(ids)
        return self.starts[at].astype(np.int64), self.lengths[at].astype(np.int64), self.ids
