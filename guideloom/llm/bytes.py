"""Words of texts by the bytes of a whole batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def table_of(keep: str) -> np.ndarray:
    """256 bytes: A-Z as a-z, the ASCII characters of keep as they are, others as a blank; bytes beyond ASCII stay."""
    table = np.full(256, 32, dtype=np.uint8)
    table[128:] = np.arange(128, 256)
    for c in keep.encode():
        table[c] = c
    table[65:91] = table[97:123]
    return table


def raw_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 ends from 0) of texts without nulls."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if offsets is not None and len(texts) else np.zeros(1, dtype=np.int32)
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, ends - ends[0]


def text_array(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int32)), pa.py_buffer(raw)])


def mapped(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """texts (without nulls) with each byte as the table has it."""
    raw, ends = raw_of(texts)
    return text_array(table[raw], ends)
