"""Windows of bases over whole batches of sequences, by numpy: two-bit codes of every place by doubling, and the letters of the places found."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .sequences import SITE

#: Bytes of sequence in one step of a task.
STEP_BYTES = 1 << 22
A, C, G, T, OTHER = range(5)
_BASES = np.full(256, OTHER, dtype=np.uint8)
_BASES[list(b"ACGT")] = range(4)
_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(b"ACGT")] = list(b"TGCA")
#: Batches sent to workers end at these bytes, as ten thousand chunks of a million bases would not fit one.
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 22)


def in_arrow(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """rows.mapInArrow(run, schema), batches bounded by their bytes; a bound that the session has set stays."""
    conf = rows.sparkSession.conf
    if BATCH_BOUND not in conf.getAll:
        conf.set(BATCH_BOUND, BATCH_BYTES)
    return rows.mapInArrow(run, schema)


def steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut to STEP_BYTES of sequence each, or one row; rows without a sequence are left out."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(column)))
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + STEP_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


class Windows:
    """The places of all sequences of an array, one after another; a window never crosses from one sequence to the next."""

    def __init__(self, sequences: pa.Array, width: int):
        sequences = pa.concat_arrays([sequences])  # from offset 0
        _, offsets, data = sequences.buffers()
        kind = np.int64 if pa.types.is_large_string(sequences.type) else np.int32
        offsets = np.frombuffer(offsets, dtype=kind)[: len(sequences) + 1].astype(np.int64) if offsets else np.zeros(1, dtype=np.int64)
        self.width, self.letters = width, np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.bases = _BASES[self.letters]
        self.n = max(len(self.bases) - width + 1, 0)
        other = np.flatnonzero(self.bases == OTHER)
        self.others = other if len(other) else None

    def at(self, k: int) -> np.ndarray:
        """The base k places after each start."""
        return self.bases[k : k + self.n]

    def starts(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence number and place of the starts where found is true and the window has only bases."""
        at = np.flatnonzero(found)
        row = np.searchsorted(self.offsets, at, side="right") - 1
        good = at + self.width <= self.offsets[row + 1]
        if self.others is not None:
            good &= np.searchsorted(self.others, at) == np.searchsorted(self.others, at + self.width)
        return row[good], at[good]

    def codes(self, at: np.ndarray) -> np.ndarray:
        """The codes of the SITE bases from each place: runs of 2, 4, 8 and 16 bases by doubling, then 16 and 4."""
        if not hasattr(self, "_runs"):
            two = (self.bases[:-1] & 3) << 2 | self.bases[1:] & 3
            four = two[:-2] << 4 | two[2:]
            eight = four[:-4].astype(np.uint16) << 8 | four[4:]
            self._runs = four, eight[:-8].astype(np.uint32) << 16 | eight[8:]
        four, sixteen = self._runs
        return sixteen[at].astype(np.int64) << 8 | four[at + 16]

    def strings(self, at: np.ndarray, width: int, turned: bool = False) -> pa.Array:
        """The letters of width bases from each place, or their reverse complements."""
        letters = self.letters[at[:, None] + np.arange(width)]
        return strings_of(_COMPLEMENT[letters[:, ::-1]] if turned else letters)


def strings_of(letters: np.ndarray) -> pa.Array:
    """Rows of letters as strings."""
    n, width = letters.shape
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(letters))])


def turned_codes(codes: np.ndarray) -> np.ndarray:
    """The codes of the reverse complements: pairs of bits turned round, then nibbles, then bytes."""
    x = codes.astype(np.uint64) ^ np.uint64((1 << 2 * SITE) - 1)
    for bits, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        bits, mask = np.uint64(bits), np.uint64(mask)
        x = (x >> bits & mask) | (x & mask) << bits
    return (x.byteswap() >> np.uint64(64 - 2 * SITE)).astype(np.int64)
