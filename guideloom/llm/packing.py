"""Best-fit packing of token sequences with a bounded number of open bins.

Documents become ids of a public word-piece vocabulary and one closing id; what is longer
than a sequence is cut into pieces. Pieces are dealt by their places into buckets of a
stated size, so that no id or text makes a bucket large. Each bucket is packed by itself,
its pieces in the order of their seeded draws and none known in advance: bounded-space
online best-fit, in which a bitset keyed by free space finds the fullest open sequence that
still takes the piece; if none does and all places for open sequences are taken, the
fullest is closed first.

Only (id, piece, start, length, checksum) is shuffled, never text or ids.

Defined cases: a null or empty text is one piece that holds the closing id alone; texts of
any length are encoded whole; repeated rows are packed as often as they stand; an empty
table gives no pieces; strings of special tokens in a text become those tokens, as the
vocabulary's own library has it.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import WordTokens, flat_words, gather, in_arrow, slices, staged, texts_of

CAPACITY, CLOSING_ID, OPEN_BINS, BUCKET_PIECES = 4096, 1, 256, 8192
WORD_END = "</w>"
#: The vocabulary's own split of a word.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Words of these characters need no normal form and have plain lower case; others go to the full tokeniser.
PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@cache
def word_tokens(path: str) -> WordTokens:
    """Ids of whole words. The line feed, which no word holds, stands for the end of a word, so that many words are encoded in one call."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    vocabulary, special = content["model"]["vocab"], [t["content"] for t in content["added_tokens"]]
    letters = byte_letters()
    ranks, ends = {}, np.zeros(max(vocabulary.values()) + 2, dtype=bool)
    for token, number in vocabulary.items():
        end = token.endswith(WORD_END)
        try:
            raw = bytes(letters[c] for c in (token[: -len(WORD_END)] if end else token))
        except KeyError:
            continue  # special tokens
        if raw and b"\n" not in raw:
            ranks[raw + b"\n" * end] = number
            ends[number] = end
    ranks[b"\n"] = len(ends) - 1
    fast = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
    full = Tokenizer.from_file(path)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, counts, odd = [], np.ones(len(words), dtype=np.int64), {}
        for k, w in enumerate(words):
            if w.isascii() and w.isalpha():
                pieces.append(w.lower())
            elif PLAIN.fullmatch(w) and not any(t in w for t in special):
                found = SPLIT.findall(w.lower())
                counts[k] = len(found)
                pieces += found
            else:
                counts[k] = 0
                odd[k] = full.encode(w, add_special_tokens=False).ids
        ids = np.array(fast.encode_ordinary("\n".join([*pieces, ""])), dtype=np.int64)
        upto = np.r_[0, np.flatnonzero(ends[ids]) + 1]  # ids before each piece
        at = np.cumsum(counts)
        lengths = upto[at] - upto[at - counts]
        if odd:
            each = np.split(ids, np.cumsum(lengths)[:-1])
            for k, own in odd.items():
                each[k], lengths[k] = np.array(own, dtype=np.int64), len(own)
            ids = np.concatenate(each)
        return lengths, ids

    return WordTokens(encode)


def document_ids(texts: pa.Array, vocabulary: str, closing_id: int = CLOSING_ID) -> tuple[np.ndarray, np.ndarray]:
    """(length of each document with its closing id, all ids)."""
    row, words = flat_words(texts)
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts, lengths, flat = word_tokens(vocabulary).look_up(words.dictionary)
    sizes = np.bincount(row, weights=lengths[code], minlength=len(texts)).astype(np.int64) + 1
    out = np.full(int(sizes.sum()), closing_id, dtype=np.uint32)
    inner = np.ones(len(out), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = flat[gather(starts[code], lengths[code])]
    return sizes, out


def pieces(docs: DataFrame, capacity: int = CAPACITY, closing_id: int = CLOSING_ID, vocabulary: str | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sizes, ids = document_ids(texts_of(batch, "_text"), vocabulary, closing_id)
            parts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), parts)
            piece = gather(np.zeros(len(parts), dtype=np.int64), parts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            raw, first = memoryview(ids.astype("<u4").tobytes()), (np.cumsum(sizes) - sizes)[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            columns = {"doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece, type=pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, type=pa.int64())}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)], type=pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        word_tokens(vocabulary).forget()

    return in_arrow(rows, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def best_fit(lengths: Iterable[int], capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each length, in the order given."""
    free = 0  # bit f is set while an open sequence has f places left
    by_free: dict[int, list[int]] = {}
    opened, made = 0, 0
    sequence, offset = [], []
    for n in lengths:
        fits = free >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            stack = by_free[left]
            at = stack.pop()
            if not stack:
                free ^= 1 << left
        else:
            at, left = made, capacity
            made += 1
            if n < capacity:
                opened += 1
                if opened > open_bins:  # close the fullest
                    least = (free & -free).bit_length() - 1
                    by_free[least].pop()
                    if not by_free[least]:
                        free ^= 1 << least
                    opened -= 1
        sequence.append(at)
        offset.append(capacity - left)
        rest = left - n
        if rest:
            by_free.setdefault(rest, []).append(at)
            free |= 1 << rest
        elif left < capacity:
            opened -= 1
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, bucket_pieces: int = BUCKET_PIECES, seed: int = 3) -> DataFrame:
    """The pieces with sequence_id and offset. Buckets hold about bucket_pieces pieces each, whatever the size of the table."""
    cut = staged(cut, "pack-pieces")
    buckets = max(1, -(-cut.count() // bucket_pieces))
    # the staged table has fixed places, so a task that runs again deals alike
    dealt = cut.withColumn("draw", F.xxhash64(F.lit(seed), F.monotonically_increasing_id())).withColumn("bucket", F.pmod("draw", F.lit(buckets)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("draw")
        sequence, offset = best_fit(group["length"].tolist(), capacity, open_bins)
        base = int(group["bucket"].iloc[0]) << 32
        return group.drop(columns=["bucket", "draw"]).assign(sequence_id=np.array(sequence, dtype=np.int64) + base, offset=np.array(offset, dtype=np.int64))

    return dealt.groupBy("bucket").applyInPandas(one, f"{fields}, sequence_id long, offset long")
