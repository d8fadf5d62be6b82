"""Spelling variant grouping by full neighbourhood generation.

For every word of the vocabulary all distinct strings that one deletion, replacement or
insertion of a letter of the observed alphabet gives are made; those that a hash join with
the vocabulary finds are its near words. No distance is computed. A word's form is its most
frequent near word, if that is frequent enough; forms followed to the end give the root.

A word has some hundred candidates, hardly any of which is a word. They are first looked up
by a hash in a filter of the vocabulary's hashes (32 bits a word, made by one aggregation), so
only those that it cannot rule out become strings and rows, and the exact join decides. Hashes
of candidates come from those of the word's beginnings and ends. The filter has a bound; a
larger vocabulary is searched in several passes, each with the filter of a share of the hashes.

Words are counted in every text in one Arrow pass with partial counts in front of the shuffle.
Forms are followed by doubling: counts at least double along a chain, so there are few rounds.

Defined cases: a null or empty text has no words; rows are counted each, also where ids or
texts repeat, and a null id counts as an empty one; ties go to the smaller word by code point;
a word without a near word has n_near 0 and is its own root; an empty vocabulary gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes import raw_of, table_of, text_array
from .shared import flat_words, in_arrow, slices, staged, texts_of

#: Letters a-z; U+00C0 to U+00FF are the two bytes of UTF-8 whose first is LEAD.
LETTERS, LEAD = table_of("abcdefghijklmnopqrstuvwxyz"), 0xC3
#: Words up to this many bytes share their checksums' shifts.
SHIFTED = 64
BITS_A_WORD, MAX_FILTER_BYTES, STEP_WORDS = 32, 64 << 20, 8192
#: Words whose neighbourhoods one task makes.
TASK_WORDS = 16_384
BASE = np.uint64(0x9E3779B97F4A7C15)


def runs_of(texts: pa.Array) -> pa.Array:
    """texts with A-Z as a-z and a blank for every byte outside runs of letters."""
    raw, ends = raw_of(texts)
    low = LETTERS[raw]
    latin = raw == LEAD
    latin[1:] |= latin[:-1].copy()
    low[(raw >= 128) & ~latin] = 32
    return text_array(low, ends)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


def joint_checksums(heads: list[bytes], row: np.ndarray, tails: list[bytes], code: np.ndarray) -> np.ndarray:
    """CRC-32 of heads[row] + tails[code] for each pair: that of the head moved on by the tail's length, and the tail's own."""
    table = _crc_table()
    size, own = np.array([len(t) for t in tails], dtype=np.int64), np.array([zlib.crc32(t) for t in tails], dtype=np.uint32)
    moved = np.zeros((min(SHIFTED, int(size.max(initial=0))) + 1, len(heads)), dtype=np.uint32)
    moved[0] = [zlib.crc32(h) for h in heads]
    for k in range(1, len(moved)):
        moved[k] = (moved[k - 1] >> np.uint32(8)) ^ table[moved[k - 1] & np.uint32(255)]
    out = moved[np.minimum(size[code], len(moved) - 1), row] ^ own[code]
    for k in np.flatnonzero(size[code] > SHIFTED).tolist():
        out[k] = zlib.crc32(tails[code[k]], int(moved[0, row[k]]))
    return out


def word_counts(docs: DataFrame, drop_every: int | None = None, min_letters: int = 5, min_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, with min_letters letters and min_count occurrences.

    drop_every: errors are planted first: a run loses a letter where this number divides the checksum of `id:run`, the one at the checksum's rest by the run's length."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(text_col).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            row, words = flat_words(runs_of(texts_of(batch, "_text")))
            if not len(row):
                continue
            known, code = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            letters = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
            edited: dict[str, int] = {}
            if drop_every:
                sums = joint_checksums([f"{i}:".encode() for i in batch.column("_id").to_pylist()], row, [w.encode() for w in known], code)
                hit = np.flatnonzero((sums % drop_every == 0) & (letters[code] > min_letters))
                gone = sums[hit] % letters[code[hit]]
                for k, at in zip(code[hit].tolist(), gone.tolist(), strict=True):
                    short = known[k][:at] + known[k][at + 1 :]
                    edited[short] = edited.get(short, 0) + 1
                code = code[sums % drop_every != 0]
            n = np.bincount(code, minlength=len(known))
            used = np.flatnonzero((n > 0) & (letters >= min_letters))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([words.dictionary.take(pa.array(used)), pa.array(list(edited), type=pa.string())]), pa.array(np.concatenate([n[used], np.fromiter(edited.values(), dtype=np.int64, count=len(edited))]))], names=["word", "n"])

    return in_arrow(rows, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _mix(x: np.ndarray) -> np.ndarray:
    """64 bits from 64 bits, each from all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(points: np.ndarray) -> np.ndarray:
    return _mix((points.astype(np.uint64) + np.uint64(1)) * BASE)


def by_length(words: pa.Array, most: int = STEP_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in words, code points as a matrix) for words of equal length, at most `most` at once."""
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for n in np.unique(length).tolist():
        where = np.flatnonzero(length == n)
        for k in range(0, len(where), step := max(1, min(most, (most * 64) // max(n, 1)))):
            some = where[k : k + step]
            joined = "".join(words.take(pa.array(some)).to_pylist())
            yield some, np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).reshape(len(some), n)


def hashes(points: np.ndarray) -> np.ndarray:
    """One hash for each row of code points."""
    total = np.zeros(len(points), dtype=np.uint64)
    for k in range(points.shape[1]):
        total = total * BASE + _values(points[:, k])
    return total


def _spots(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, mask of three bits) of hashes in a filter of size slots of 64 bits; size is a power of two."""
    x, one, six = _mix(h), np.uint64(1), np.uint64(63)
    mask = (one << (x >> np.uint64(58))) | (one << ((x >> np.uint64(52)) & six)) | (one << ((x >> np.uint64(46)) & six))
    return x & np.uint64(size - 1), mask


def neighbourhood(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[str, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, place, rows, letters, hashes) of all distinct strings one edit away from words of equal length: `delete` the letter at the place, `replace` it, or `insert` one before it."""
    m, n = points.shape
    letters = _values(alphabet)
    power = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(n + 1, BASE))])
    value = _values(points.reshape(-1)).reshape(m, n)
    tails = np.zeros((n + 1, m), dtype=np.uint64)  # hash of what starts at a place
    for k in reversed(range(n)):
        tails[k] = tails[k + 1] + value[:, k] * power[n - 1 - k]
    head = np.zeros(m, dtype=np.uint64)
    each, no_letter = np.arange(m), np.zeros(m, dtype=np.int64)
    for k in range(n + 1):
        fresh = np.ones(m, dtype=bool) if k == 0 or k == n else points[:, k] != points[:, k - 1]  # one of equal letters in a row stands for all
        if k < n:
            yield "delete", k, each[fresh], no_letter[fresh], (head * power[n - 1 - k] + tails[k + 1])[fresh]
            rows, which = np.nonzero(points[:, k][:, None] != alphabet[None, :])
            yield "replace", k, rows, which, (head * power[n - k] + tails[k + 1])[rows] + (letters * power[n - 1 - k])[which]
        other = np.ones((m, len(alphabet)), dtype=bool) if k == 0 else points[:, k - 1][:, None] != alphabet[None, :]
        rows, which = np.nonzero(other)
        yield "insert", k, rows, which, (head * power[n - k + 1] + tails[k])[rows] + (letters * power[n - k])[which]
        if k < n:
            head = head * BASE + value[:, k]


def _size(n_words: int, shares: int) -> int:
    """Slots of a filter: a power of two with BITS_A_WORD bits for each word of a share."""
    return 1 << max(6, (max(n_words // shares, 1) * BITS_A_WORD // 64 - 1).bit_length())


def filters(words: DataFrame, size: int, shares: int) -> list[np.ndarray]:
    """The filter of each share of the hashes: size slots, made by one aggregation; each reaches the driver with at most 16 bytes a slot."""

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word"):
            for _, points in by_length(batch.column("word")):
                h = hashes(points)
                slot, mask = _spots(h, size)
                yield pa.RecordBatch.from_arrays([pa.array((h % np.uint64(shares)).astype(np.int32)), pa.array(slot.astype(np.int64)), pa.array(mask.view(np.int64))], names=["share", "slot", "mask"])

    found = staged(in_arrow(words.select("word"), spots, "share int, slot long, mask long").groupBy("share", "slot").agg(F.bit_or("mask").alias("mask")), "spelling-filter")
    out = []
    for share in range(shares):
        rows, bits = found.filter(F.col("share") == share).select("slot", "mask").toArrow(), np.zeros(size, dtype=np.uint64)
        bits[rows.column("slot").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
        out.append(bits)
    return out


def candidates(words: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(word, n, near): the strings of each word's neighbourhood that a filter of the vocabulary does not rule out; none of the vocabulary is lost."""
    spark = words.sparkSession
    alphabet = np.array(sorted(ord(r["c"]) for r in words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().collect()), dtype=np.uint32)
    spelled = [chr(x) for x in alphabet.tolist()]
    n_words = words.count()
    shares = max(1, -(-n_words * BITS_A_WORD // 8 // max_filter_bytes))
    size = _size(n_words, shares)

    def search(share: int, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = shared.value
            for batch in slices(batches, "word", 1 << 18):
                for where, points in by_length(batch.column("word")):
                    known = batch.column("word").take(pa.array(where)).to_pylist()
                    of, near = [], []
                    for kind, k, rows, which, h in neighbourhood(points, alphabet):
                        slot, mask = _spots(h, size)
                        kept = (bits[slot] & mask) == mask
                        if shares > 1:
                            kept &= h % np.uint64(shares) == share
                        kept = np.flatnonzero(kept)
                        of += rows[kept].tolist()
                        after = k if kind == "insert" else k + 1
                        near += [known[r][:k] + ("" if kind == "delete" else spelled[c]) + known[r][after:] for r, c in zip(rows[kept].tolist(), which[kept].tolist(), strict=True)]
                    at = pa.array(where[np.array(of, dtype=np.int64)])
                    yield pa.RecordBatch.from_arrays([batch.column("word").take(at), batch.column("n").take(at), pa.array(near, type=pa.string())], names=["word", "n", "near"])

        return in_arrow(words.select("word", "n").repartition(-(-n_words // TASK_WORDS) or 1, "word"), run, "word string, n long, near string")

    found = [search(share, spark.sparkContext.broadcast(bits)) for share, bits in enumerate(filters(words, size, shares))]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_words(words: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have near ones. words: (word, n), each word once."""
    met = candidates(words, **options).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    form = F.when(F.col("near_n") >= ratio * F.col("n"), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    best = met.groupBy("word").agg(F.count("*").alias("n_near"), F.min(form).alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round doubles how far a word has come; chains have an end."""
    found, moved = staged(links.select("word", F.col("form").alias("root")), "spelling-roots"), 1
    while moved:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = staged(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        moved = found.filter("moved").count()
        found = found.drop("moved")
    return found


def grouped(words: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """word, form (its near word of largest n, if that is at least ratio times its own), root, n, n_near, form_n: one row a word. words: (word, n), each word once."""
    words = staged(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = staged(near_words(words, ratio, **options), "spelling-near")
    ends = roots(near.filter("form is not null"))
    out = words.join(near, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
