"""Removal of repeated passages with sparse suffix arrays, sorted deep-shallow.

A byte goes if a string of `span` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one. Strings never cross documents.

1. Anchors. In each string of span bytes the places of the least hash of all its 32-byte
   grams are anchors: about one byte in 35. Equal strings have equal anchors at equal
   places, so whoever compares the surroundings of equal anchors misses nothing.
2. Surroundings are the bytes that a string of span bytes through the anchor can reach.
   Of equal anchors (a 64-bit hash) with equal surroundings (another 64 bits, of all their
   bytes), all but the first repeat throughout. What is left of an anchor that stands alone is dropped; where different
   surroundings are left, their bytes are cut out.
3. The surroundings of equal anchors are sorted twice, to the right of the anchor and
   backwards to its left: multikey quicksort to a shallow depth, then a blind trie for
   each group whose common prefix is longer. Two anchors share a string that starts o
   bytes before them if their right sides agree for span - o bytes and their left sides
   for o; both are runs in the sorted orders, so for each o the first of each pair of
   runs stays and the others are marked.
4. Marks are joined to stretches and cut from the text.

Anchors, never whole suffixes, are shuffled by hash; the text is shuffled once, by
document, and that exchange serves twice. An anchor that is frequent in one step is known
not to stand alone, so its surroundings are dealt out by digest, and one with more than
GROUP_ROWS different surroundings is cut into smaller groups by longer and longer bytes
around it, until those of different bytes are apart (see smaller_groups): no task holds or
orders more of one anchor than that.

Defined cases: null and empty texts and texts shorter than span lose nothing; rows that
share an id are ordered by a hash of their text; rows that share id and text are one
document and give equal rows; null ids come last; long runs of one pattern are anchors
throughout, of which only the first surroundings are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import gather, in_arrow, slices, staged

SPAN, GRAM, SHALLOW = 100, 32, 16
#: Bytes of text that one step hashes, and surroundings that one step sorts.
STEP_BYTES, STEP_ROWS = 1 << 20, 100_000
#: Different surroundings of an anchor that one task sorts at once, and how many in one step make an anchor frequent.
GROUP_ROWS, FREQUENT = 65_536, 4


def _table() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASHES = _table()
FACTORS = [np.uint64(2 * int(x) + 1) for x in BYTE_HASHES[:8] >> np.uint64(1)]


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash for each start of a gram, put together from stretches that are powers of two; never 0."""
    part, size, level, whole, done = BYTE_HASHES[raw], 1, 0, None, 0
    while True:
        if gram & size:
            whole = part if whole is None else whole[: len(raw) - done - size + 1] * FACTORS[6] + part[done:]
            done += size
        if 2 * size > gram:
            break
        part = part[:-size] * FACTORS[level] + part[size:]
        size, level = 2 * size, level + 1
    h = whole ^ (whole >> np.uint64(32))
    h *= FACTORS[7]
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of each `width` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchors(raw: np.ndarray, ends: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of texts that stand one after another and end at `ends`."""
    if len(raw) < span:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    width = span - gram + 1
    h = gram_hashes(raw, gram)
    least = sliding(h, width, np.minimum)  # for each start of a string
    starts = np.r_[0, ends[:-1]]
    inside = np.zeros(len(least) + 1, dtype=np.int32)
    ok = ends - starts >= span
    np.add.at(inside, starts[ok], 1)
    np.add.at(inside, ends[ok] - span + 1, -1)
    least[np.cumsum(inside)[:-1] == 0] = 0
    around = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    places = np.flatnonzero(sliding(around, width, np.maximum) == h)
    return places, h[places]


def text_anchors(raw: np.ndarray, ends: np.ndarray, step: int = STEP_BYTES, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """As anchors, in steps over the starts of strings, so that a very long text takes bounded memory."""
    found = []
    for a in range(0, max(1, len(raw)), step):
        b = min(len(raw), a + step + span - 1)
        cut = ends[(ends > a) & (ends < b)] - a
        places, hashes = anchors(raw[a:b], np.r_[cut, b - a], span, gram)
        found.append((places + a, hashes))
    places, first = np.unique(np.concatenate([p for p, _ in found]), return_index=True)
    return places, np.concatenate([h for _, h in found])[first]


class BlindTrie:
    """Sorts strings by a trie whose nodes know only the depth and letter at which they part."""

    def __init__(self) -> None:
        self.root: object = None

    @staticmethod
    def letter(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def insert(self, s: bytes, number: int) -> None:
        if self.root is None:
            self.root = (s, [number])
            return
        node = self.root
        while isinstance(node, list):  # blind: a missing letter takes any way down
            kids = node[1]
            node = kids.get(self.letter(s, node[0])) or next(iter(kids.values()))
        other, numbers = node
        if other == s:
            numbers.append(number)
            return
        n = min(len(s), len(other))
        parted = int.from_bytes(s[:n]) ^ int.from_bytes(other[:n])
        common = n - (parted.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, list) and node[0] < common:
            above, node = node, node[1][self.letter(s, node[0])]
        leaf = (s, [number])
        if isinstance(node, list) and node[0] == common:
            node[1][self.letter(s, common)] = leaf
            return
        fork = [common, {self.letter(other, common): node, self.letter(s, common): leaf}]
        if above is None:
            self.root = fork
        else:
            above[1][self.letter(s, above[0])] = fork

    def order(self) -> list[int]:
        out, todo = [], [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out += node[1]
        return out


def deep_shallow(group: np.ndarray, rows: np.ndarray, lengths: np.ndarray, common: int, shallow: int = SHALLOW) -> np.ndarray:
    """The order of rows (bytes, zeros after `lengths`) within their groups.

    Multikey quicksort, eight bytes a key and all open segments at once: each round parts
    every segment by a pivot in three, less, equal and greater, and only the equal part goes
    on eight bytes deeper. It starts behind the `common` bytes that rows of a group share (by
    their hash; where that is wrong, all rows go to the trie); equal parts `shallow` bytes
    further go to a blind trie."""
    n, width = rows.shape
    order = np.argsort(group, kind="stable")
    fresh = np.diff(group[order]) != 0
    if common:  # the hash may be that of other bytes
        odd = (rows[order[1:], :common] != rows[order[:-1], :common]).any(axis=1) & ~fresh
        mixed = np.zeros(int(group.max()) + 1 if n else 0, dtype=bool)
        mixed[group[order[1:][odd]]] = True
    keys = [np.pad(rows[:, a : a + 8], ((0, 0), (0, max(0, a + 8 - width)))).copy().view(">u8").ravel() for a in range(common, min(common + shallow, width), 8)]
    begins = np.flatnonzero(np.r_[True, fresh])
    sizes = np.diff(np.r_[begins, n])
    depths = np.zeros(len(begins), dtype=np.int64)
    if common:
        depths[mixed[group[order[begins]]]] = len(keys)
    deep = []
    while len(begins):
        done = (sizes > 1) & (depths == len(keys))
        deep += zip(begins[done].tolist(), sizes[done].tolist(), strict=True)
        going = (sizes > 1) & ~done
        begins, sizes, depths = begins[going], sizes[going], depths[going]
        if not len(begins):
            break
        place, segment = gather(begins, sizes), np.repeat(np.arange(len(begins)), sizes)
        held = order[place]
        key = np.stack(keys)[depths[segment], held] if len(keys) > 1 else keys[0][held]
        third = (np.cumsum(sizes) - sizes)[:, None] + np.stack([np.zeros_like(sizes), sizes // 2, sizes - 1], axis=1)
        pivot = np.sort(key[third], axis=1)[:, 1][segment]  # median of three
        part = 3 * segment + (key >= pivot) + (key > pivot)
        by = np.argsort(part, kind="stable")
        order[place] = held[by]
        part = part[by]
        opens = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        begins, sizes = place[opens], np.diff(np.r_[opens, len(part)])
        depths = depths[part[opens] // 3] + (part[opens] % 3 == 1)
    for a, m in deep:
        trie = BlindTrie()
        for k in order[a : a + m].tolist():
            trie.insert(rows[k, : lengths[k]].tobytes(), k)
        order[a : a + m] = trie.order()
    return order


def neighbour_prefixes(order: np.ndarray, group: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it in the order; -1 at the start of a group."""
    a, b = order[:-1], order[1:]
    differ = rows[a] != rows[b]
    found = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    found = np.minimum(found, np.minimum(lengths[a], lengths[b]))
    return np.r_[-1, np.where(group[a] == group[b], found, -1)]


def repeated_around(group: np.ndarray, left: np.ndarray, before: np.ndarray, right: np.ndarray, after: np.ndarray, span: int = SPAN, gram: int = GRAM, low: np.ndarray | int = 0, high: np.ndarray | int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor, (least, most) o for which the string that starts o bytes before it also stands around an earlier anchor of its group; most is -1 if there is none. Only o from low to high count.

    Rows come in order of place. left: the bytes before the anchor, backwards."""
    n = len(group)
    least, most = np.full(n, span), np.full(n, -1)
    runs = []
    for rows, lengths, common in ((right, after, gram), (left, before, 0)):
        order = deep_shallow(group, rows, lengths, common)
        runs.append((order, neighbour_prefixes(order, group, rows, lengths)))
    (order_r, prefix_r), (order_l, prefix_l) = runs
    run_r, run_l = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(span - gram + 1):
        run_r[order_r] = np.cumsum(prefix_r < span - o)
        run_l[order_l] = np.cumsum(prefix_l < o)
        able = np.flatnonzero((after >= span - o) & (before >= o) & (low <= o) & (o <= high))
        first = np.unique(run_r[able] * (n + 1) + run_l[able], return_index=True)[1]
        later = np.ones(len(able), dtype=bool)
        later[first] = False
        hit = able[later]
        least[hit] = np.minimum(least[hit], o)
        most[hit] = o
    return least, most


def surroundings(raw: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Bytes from span - gram before to span after each place, zeros outside [low, high)."""
    reach = span - gram
    room = np.concatenate([np.zeros(reach, dtype=np.uint8), raw, np.zeros(span, dtype=np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(room, reach + span)[at]
    edge = np.flatnonzero((at - reach < low) | (at + span > high))
    if len(edge):
        place = at[edge, None] + np.arange(-reach, span)
        out[edge] = np.where((place >= low[edge, None]) & (place < high[edge, None]), out[edge], 0)
    return out


def digests(rows: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row of bytes and of the numbers beside it."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : rows.shape[1]] = rows
    h = np.full(len(rows), FACTORS[0])
    for word in [*wide.view("<u8").T, *(m.astype(np.uint64) for m in more)]:
        h = (h ^ word) * FACTORS[1]
        h ^= h >> np.uint64(29)
        h = h * FACTORS[2]
        h ^= h >> np.uint64(32)
    return h


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (seq, doc_id, text), and the same with each seq once: seq orders the documents. The id itself if it is a whole number, never null and never repeated; else numbers along a range sort."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if rows.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte"):
        repeated = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count()
        if not repeated:
            rows = rows.select(F.col("doc_id").cast("long").alias("seq"), "doc_id", "text")
            return rows, rows
    rows = rows.withColumn("h", F.xxhash64("text"))
    distinct = rows.select("doc_id", "h").distinct()
    by = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    numbers = staged(distinct.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("seq", F.monotonically_increasing_id()), "suffix-order")
    r, n = rows.alias("r"), numbers.alias("n")
    joined = staged(r.join(n, F.col("r.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("r.h") == F.col("n.h"))).select("seq", "r.doc_id", "text"), "suffix-documents")
    return joined, joined.dropDuplicates(["seq"])


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, most_rows: int = GROUP_ROWS) -> DataFrame:
    """(seq, low, high): stretches of bytes to remove, as they come from each anchor. docs: (seq, doc_id, text)."""
    reach = span - gram

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
            seqs = np.array(batch.column("seq").to_pylist(), dtype=np.int64)
            all_places, all_hashes = text_anchors(raw, ends, span=span, gram=gram)
            for a in range(0, len(all_places), STEP_ROWS):
                places, hashes = all_places[a : a + STEP_ROWS], all_hashes[a : a + STEP_ROWS]
                of = np.searchsorted(ends, places, side="right")
                low, high = np.r_[0, ends][of], ends[of]
                at, after = places - low, np.minimum(high - places, span)
                digest = digests(surroundings(raw, places, low, high, span, gram), np.minimum(at, reach), after)
                seq = seqs[of]
                order = np.lexsort((at, seq))
                again = np.ones(len(at), dtype=bool)  # seen here before: settled, and kept away from the task of a frequent anchor
                again[order[np.unique(digest[order], return_index=True)[1]]] = False
                # the different surroundings of an anchor that is frequent here: all but the first are dealt out by digest, marked as not alone
                new = order[~again[order]]
                _, first, which, times = np.unique(hashes[new], return_index=True, return_inverse=True, return_counts=True)
                many = np.zeros(len(at), dtype=bool)
                many[new] = times[which] >= FREQUENT
                dealt = many.copy()
                dealt[new[first]] = False
                key = np.where(again, digest ^ digests(np.zeros((len(at), 0), dtype=np.uint8), seq, at), np.where(dealt, digest ^ hashes, hashes))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(hashes.view(np.int64), mask=~dealt), pa.array(digest.view(np.int64)), pa.array(seq), pa.array(at), pa.array(after.astype(np.int32)), pa.array(again), pa.array(many)], names=["key", "hash", "digest", "seq", "at", "after", "again", "many"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks = batch.column("marks")
            counts = np.array([len(m) if m.is_valid else 0 for m in marks])
            if not counts.sum():
                continue
            texts = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            starts = np.r_[0, ends[:-1]]
            raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
            flat, seqs = marks.flatten(), np.array(batch.column("seq").to_pylist(), dtype=np.int64)
            all_at, all_hashes, all_of = flat.field("at").to_numpy(zero_copy_only=False), flat.field("hash").to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), counts)
            for a in range(0, len(all_at), STEP_ROWS):
                at, of = all_at[a : a + STEP_ROWS], all_of[a : a + STEP_ROWS]
                context = surroundings(raw, at + starts[of], starts[of], ends[of], span, gram)
                after = np.minimum(ends[of] - starts[of] - at, span)
                width = context.shape[1]
                body = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((np.arange(len(at) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(context))])
                yield pa.RecordBatch.from_arrays([pa.array(all_hashes[a : a + STEP_ROWS]), pa.array(seqs[of]), pa.array(at), pa.array(after.astype(np.int32)), body], names=["hash", "seq", "at", "after", "body"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last group, which may go on in the next batch; no group has more than `most` rows
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "seq", "at", "after", "least", "most")]
            rows.append(np.frombuffer(b"".join(batch.column("body").to_pylist()), dtype=np.uint8).reshape(-1, span + reach))
            told = 0
            if held is not None and held[0][0] == rows[0][0]:
                told = len(held[0])
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
            keys, seq, at, after, low, high, context = rows
            group = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).astype(np.int64)])
            least, most = repeated_around(group, np.ascontiguousarray(context[:, :reach][:, ::-1]), np.minimum(at, reach), np.ascontiguousarray(context[:, reach:]), after.astype(np.int64), span, gram, low, high)
            hit = most >= 0
            hit[:told] = False
            held = [x[group == group[-1]] for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array(seq[hit]), pa.array((at - most)[hit]), pa.array((at - least + span)[hit])], names=["seq", "low", "high"])

    found = in_arrow(docs.select("seq", "text"), find, "key long, hash long, digest long, seq long, at long, after int, again boolean, many boolean")
    same, alike = Window.partitionBy("key", "digest").orderBy("seq", "at"), Window.partitionBy("key")
    shared = found.withColumn("nth", F.row_number().over(same)).withColumn("low", F.min("digest").over(alike)).withColumn("high", F.max("digest").over(alike)).withColumn("known", F.max("many").over(alike))
    mark = (F.col("nth") == 1) & ((F.col("low") != F.col("high")) | F.col("known")) & ~F.col("again")
    before = F.least(F.col("at"), F.lit(reach))
    repeat = (F.col("again") | (F.col("nth") > 1)) & (before + F.col("after") >= span)
    settled = staged(shared.filter(mark | repeat).select("seq", "at", "after", F.when(mark, F.coalesce("hash", "key")).alias("hash")), "suffix-anchors")  # read often, found once
    whole = settled.filter("hash is null").select("seq", (F.col("at") - before).alias("low"), (F.col("at") + F.col("after")).alias("high"))
    marked = settled.filter("hash is not null")
    marks = marked.groupBy("seq").agg(F.collect_list(F.struct("at", "hash")).alias("marks"))
    around = in_arrow(docs.join(marks, "seq", "left"), cut, "hash long, seq long, at long, after int, body binary")
    around = around.select(F.col("hash").alias("key"), "seq", "at", "after", F.lit(0).alias("least"), F.lit(reach).alias("most"), "body")
    large = staged(marked.groupBy("hash").count().filter(F.col("count") > most_rows).select(F.col("hash").alias("key")), "suffix-large")
    known = whole
    if large.limit(1).count():
        around = staged(around, "suffix-around")
        around, certain = smaller_groups(around.join(large, "key", "left_anti"), around.join(large, "key", "left_semi"), span, reach, most_rows)
        known = known.unionByName(certain)
    parts = in_arrow(around.repartition("key").sortWithinPartitions("key", "seq", "at"), resolve, "seq long, low long, high long")
    return known.unionByName(parts)


def smaller_groups(small: DataFrame, large: DataFrame, span: int, reach: int, most_rows: int) -> tuple[DataFrame, DataFrame]:
    """(rows in groups of at most most_rows, stretches to remove for certain). Rows: key, seq, at, after, least, most, body.

    Strings that start least to most bytes before an anchor all hold the bytes from `least`
    before it to span - most behind it. So a large group is cut by those bytes, for each half
    of the range by itself, and those of different bytes never meet; most rows are then alone
    and out. At last the range is one place, and the bytes are the string itself: all but the
    first row of such a group are repeats."""
    done, certain = [small], []
    while True:
        middle = F.floor((F.col("least") + F.col("most")) / 2).cast("int")
        halves = F.array(F.struct(F.col("least").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("most").alias("b")))
        cut = large.withColumn("half", F.explode(halves)).withColumn("least", F.col("half.a")).withColumn("most", F.col("half.b")).drop("half")
        cut = cut.filter((F.col("least") <= F.col("most")) & (F.least("at", F.lit(reach)) >= F.col("least")) & (F.col("after") >= span - F.col("most")))
        core = F.expr(f"substring(body, {reach} - least + 1, {span} + least - most)")
        cut = cut.withColumn("key", F.xxhash64("key", "least", F.md5(core)))
        sizes = cut.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        sized = staged(cut.join(sizes, "key"), "suffix-cut")
        done.append(sized.filter(F.col("n") <= most_rows).drop("n"))
        over = sized.filter(F.col("n") > most_rows)
        one = over.filter("least = most")
        first = one.groupBy("key").agg(F.min(F.struct("seq", "at")).alias("first"))
        certain.append(one.join(first, "key").filter(F.struct("seq", "at") != F.col("first")).select("seq", (F.col("at") - F.col("least")).alias("low"), (F.col("at") - F.col("least") + span).alias("high")))
        large = over.filter("least < most").drop("n")
        if not large.limit(1).count():
            return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, certain)


def without_repeats(docs: DataFrame, span: int = SPAN, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes that stay)."""
    rows, once = numbered(docs, id_col, text_col)
    spans = repeated_spans(once, span, most_rows=GROUP_ROWS).groupBy("seq").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw = (text.as_py() or "").encode()
                removed = n_spans = 0
                if found.is_valid:
                    low, high = found.values.field("low").to_numpy(), found.values.field("high").to_numpy()
                    order = np.argsort(low, kind="stable")
                    low, upto = low[order], np.maximum.accumulate(high[order])
                    opens = np.flatnonzero(np.r_[True, low[1:] > upto[:-1]])
                    starts, ends = low[opens], upto[np.r_[opens[1:] - 1, len(low) - 1]]
                    removed, n_spans = int((ends - starts).sum()), len(starts)
                    raw_ends = np.r_[starts, len(raw)].tolist()
                    kept = b"".join(raw[a:b] for a, b in zip(np.r_[0, ends].tolist(), raw_ends, strict=True))
                else:
                    kept = raw
                out.append((len(raw), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]][: 6 if with_text else 5], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_text else 5])

    return in_arrow(rows.join(spans, "seq", "left"), remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
