"""Language-model scores by deleted interpolation.

A word's probability after the word before it is a mixture: of the share of the pair among the
pairs of its context, of the word's own share, and of an equal share for every word and one
unknown. The weight of the pairs depends on how often the context was seen, by powers of two;
the weights are learned by expectation-maximisation on a deleted part of the training
documents, against the counts that remain without it, and then used with the counts of all.

Counts cover all training documents, and every pair of every document asks for its count:

1. One pass packs documents into blocks of about `block_bytes`: ids, distinct words, tokens.
2. Blocks ask for counts. The distinct words of a block, and its distinct pairs, go to parts by
   their hash, a row for each block and part; a part sums the training counts of equal keys
   and answers in the order of the question, so answers are short. A frequent word or pair
   counts once a block, so no key is hot.
3. Weights come from histograms (by context frequency) of how much better a pair's share is
   than the word's; those are all that reach the driver, and have a bound whatever the input.
4. Blocks meet their answers and score their documents. Texts are never shuffled.

Words are counted by their letters, exactly; pairs are known by 64 bits, so two of n pairs
share a count with probability n^2 / 2^65, which can touch `score` only. One task holds a block
(its largest document at least) or a part (about `part_keys` keys).

Defined cases: a null or empty text is one end token; a null id counts as an empty one where
ids decide; repeated rows count each; without training documents every word is unknown and base_score
is 0 for each token; a context frequency that the deleted part never meets takes half and half.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, flat_words, in_arrow, shared_dir, slices, staged, sums, texts_of

BLOCK_BYTES, PART_KEYS = 8 << 20, 1 << 20
#: Stands for what precedes a text, among the hashes of words. Any number will do.
BEGIN = np.uint64(0xB5297A4D3F84D5B5)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Steps of histograms for each unit of a natural logarithm, and the step of zero.
STEPS, NEVER = 1000, -(1 << 30)
ROUNDS = 200


def _one(values: pa.Array) -> pa.ListArray:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], type=pa.int32()), values)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes, those of equal weight together and compressed: small ones take about a byte."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").reshape(-1)


def blocks(docs: DataFrame, may_learn: Column, delete: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, deleted, ids, learned, sizes (tokens of each document), words (the first is the end), tokens, and three sums. Deleted documents have blocks of their own."""
    learned, deleted = F.coalesce(may_learn, F.lit(False)), F.coalesce(may_learn & delete, F.lit(False))
    rows = docs.select(F.col(id_col).alias("_id"), learned.alias("_learned"), deleted.alias("_deleted"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def pack(parts: list[pa.RecordBatch], number: int, deleted: bool) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        row, words = flat_words(ascii_lower(texts_of(whole, "_text")))
        per_doc = sums(row, None, whole.num_rows)
        tokens = np.zeros(len(row) + whole.num_rows, dtype=np.int32)
        tokens[np.arange(len(row)) + row] = words.indices.to_numpy(zero_copy_only=False) + 1
        spelled = pa.concat_arrays([pa.array([""], type=pa.string()), words.dictionary.cast(pa.string())])
        learned = whole.column("_learned").to_numpy(zero_copy_only=False)
        columns = {"block": pa.array([(TaskContext.get().partitionId() << 32) | number]), "deleted": pa.array([deleted]), "ids": _one(whole.column("_id")), "learned": _one(whole.column("_learned")), "sizes": pa.array([packed(per_doc + 1)]), "words": _one(spelled), "tokens": pa.array([packed(tokens)])}
        columns |= {"n_words": pa.array([len(spelled)]), "n_tokens": pa.array([len(tokens)]), "n_learned": pa.array([int((per_doc + 1)[learned].sum())]), "n_docs": pa.array([int(learned.sum())])}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        size, number = {False: 0, True: 0}, 0
        for batch in slices(batches, "_text"):
            for deleted in waiting:
                part = batch.filter(pc.equal(batch.column("_deleted"), deleted))
                if part.num_rows:
                    waiting[deleted].append(part)
                    size[deleted] += (pc.sum(pc.binary_length(part.column("_text"))).as_py() or 0) + part.num_rows
                if size[deleted] >= block_bytes:
                    yield pack(waiting[deleted], number, deleted)
                    waiting[deleted], size[deleted], number = [], 0, number + 1
        for deleted, parts in waiting.items():
            if parts:
                yield pack(parts, number, deleted)
                number += 1

    return in_arrow(rows, build, f"block long, deleted boolean, ids array<{kind}>, learned array<boolean>, sizes binary, words array<string>, tokens binary, n_words long, n_tokens long, n_learned long, n_docs long")


def _whole(table: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    found = table.column(name)
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def _tokens(block: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, sizes) of the only row."""
    return tuple(unpacked(_whole(block, c)[0].as_py()) for c in ("tokens", "sizes"))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in words), dtype=np.uint64, count=len(words))


def pair_hashes(h: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """64 bits of pairs, given as context * len(h) + word; the context len(h) is the beginning."""
    context = np.append(h, BEGIN)[pair // len(h)]
    x = context * SPREAD + h[pair % len(h)]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def contexts(tokens: np.ndarray, sizes: np.ndarray, n_words: int) -> np.ndarray:
    """The word before each token; n_words at the beginning of a document."""
    before = np.empty(len(tokens), dtype=np.int64)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = n_words
    return before


def _dealt(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in order of their hashes, parts in that order): a part is a range of hashes."""
    order = np.argsort(h, kind="stable")
    return order, (((h[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def asked(blocks: DataFrame, parts: int, pairs: bool) -> DataFrame:
    """part, block, deleted, keys (the distinct words of a block in this part; of pairs the steps from one hash to the next), n (their occurrences in training documents, packed)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                words, (tokens, sizes) = row.column("words").flatten(), _tokens(row)
                learned = np.repeat(row.column("learned").flatten().to_numpy(zero_copy_only=False), sizes)
                h = word_hashes(words.to_pylist())
                if pairs:
                    found, which = np.unique(contexts(tokens, sizes, len(h)) * len(h) + tokens, return_inverse=True)
                    h, tokens = pair_hashes(h, found), which
                n = np.bincount(tokens, weights=learned, minlength=len(h)).astype(np.int64)
                order, part = _dealt(h, parts)
                some, first = np.unique(part, return_index=True)
                ends = np.append(first, len(order))
                if pairs:
                    keys = pa.array([packed(np.diff(x, prepend=np.uint64(0)).view(np.int64)) for x in np.split(h[order], first[1:])])
                else:
                    keys = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words.take(pa.array(order)))
                same = pa.array(np.zeros(len(some), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(some), row.column("block").take(same), row.column("deleted").take(same), keys, pa.array([packed(x) for x in np.split(n[order], first[1:])])], names=["part", "block", "deleted", "keys", "n"])

    return in_arrow(blocks.select("block", "deleted", "learned", "sizes", "words", "tokens"), ask, f"part long, block long, deleted boolean, keys {'binary' if pairs else 'array<string>'}, n binary")


def answered(questions: DataFrame) -> DataFrame:
    """block, kind, part, deleted, c (occurrences of each key in all training documents) and, for deleted blocks, d (in the deleted ones), both packed and in the order of the question; and, in one row a part: distinct (keys with occurrences), steps and weights (histogram of what remains of keys without the deleted part, by deleted occurrences)."""
    kind = "words" if questions.schema["keys"].dataType.simpleString() != "binary" else "pairs"

    def answer(group: pa.Table) -> pa.Table:
        n = [unpacked(x.as_py()) for x in group.column("n")]
        lengths, deleted = np.array([len(x) for x in n]), group.column("deleted").to_numpy()
        if kind == "words":
            code = _whole(group, "keys").flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        else:
            code = pa.array(np.concatenate([np.cumsum(unpacked(x.as_py())) for x in group.column("keys")])).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n, gone = np.concatenate(n), np.repeat(deleted, lengths)
        c, d = np.bincount(code, weights=n).astype(np.int64), np.bincount(code, weights=n * gone).astype(np.int64)
        steps, weights = histogram((c - d)[d > 0].astype(np.float64), d[d > 0])
        once = lambda values: pa.ListArray.from_arrays(pa.array(np.append(0, np.full(len(lengths), len(values))).astype(np.int32)), pa.array(values))
        distinct = np.zeros(len(lengths), dtype=np.int64)
        distinct[0] = (c > 0).sum()
        own = np.split(code, np.cumsum(lengths)[:-1])
        columns = {"block": group.column("block"), "kind": pa.array([kind] * len(lengths)), "part": group.column("part"), "deleted": group.column("deleted")}
        columns |= {"c": pa.array([packed(c[x]) for x in own]), "d": pa.array([packed(d[x]) if g else None for x, g in zip(own, deleted, strict=True)], type=pa.binary())}
        return pa.table(columns | {"distinct": pa.array(distinct), "steps": once(steps), "weights": once(weights)})

    return questions.groupBy("part").applyInArrow(answer, "block long, kind string, part long, deleted boolean, c binary, d binary, distinct long, steps array<long>, weights array<long>")


def histogram(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps of the logarithm, their summed weights)."""
    step = np.full(len(values), NEVER, dtype=np.int64)
    step[values > 0] = np.floor(STEPS * np.log(values[values > 0])).astype(np.int64)
    found, which = np.unique(step, return_inverse=True)
    return found, np.bincount(which, weights=weights, minlength=len(found)).astype(np.int64)


def mixture_weight(step: np.ndarray, weight: np.ndarray, scale: float = 1.0, rounds: int = ROUNDS) -> float:
    """Expectation-maximisation of a mixture of two: the weight of the first, from a histogram of how many times as probable it makes an event as the second. Half without events; never 0 or 1."""
    if not weight.sum():
        return 0.5
    ratio = np.where(step == NEVER, 0.0, np.exp((step + 0.5) / STEPS)) * scale
    share = 0.5
    for _ in range(rounds):
        share = float((weight * (share * ratio / (share * ratio + 1 - share))).sum() / weight.sum())
        share = min(max(share, 1e-6), 1 - 1e-6)
    return share


class Counts:
    """What a block needs of its answers: for each token the counts (column c, or d) of the word, its context and the pair."""

    def __init__(self, block: pa.Table, answers: pa.Table, parts: dict[str, int]):
        self.tokens, self.sizes = _tokens(block)
        h = word_hashes(_whole(block, "words").flatten().to_pylist())
        self.before = contexts(self.tokens, self.sizes, len(h))
        pairs, self.pairs = np.unique(self.before * len(h) + self.tokens, return_inverse=True)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.answers = answers.sort_by("part")
        self.order = {"words": _dealt(h, parts["words"])[0], "pairs": _dealt(pair_hashes(h, pairs), parts["pairs"])[0]}

    def of(self, column: str, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, context, pair); documents is the count of beginnings."""
        words, pairs = self._in_order("words", column), self._in_order("pairs", column)
        return words[self.tokens], np.append(words, documents)[self.before], pairs[self.pairs]

    def _in_order(self, kind: str, column: str) -> np.ndarray:
        own = self.answers.filter(pc.equal(self.answers.column("kind"), kind)).column(column)
        out = np.empty(len(self.order[kind]), dtype=np.int64)
        out[self.order[kind]] = np.concatenate([unpacked(x.as_py()) for x in own])
        return out


class Model:
    """Totals and weights: all that scoring needs beside the counts."""

    def __init__(self, tokens: int, deleted_tokens: int, documents: int, deleted_documents: int, distinct: int):
        self.tokens, self.remaining, self.distinct = tokens, tokens - deleted_tokens, distinct
        self.documents = (documents, deleted_documents)
        self.word_weight, self.pair_weights = 0.5, np.full(65, 0.5)

    def of_word(self, count: np.ndarray, tokens: int) -> np.ndarray:
        if not tokens:
            return np.full(len(count), 1 / (self.distinct + 1))
        return self.word_weight * count / tokens + (1 - self.word_weight) / (self.distinct + 1)

    def of_pair(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The mixture: pairs by the weight of their context's frequency."""
        weight = np.where(context > 0, self.pair_weights[frequency(context)], 0.0)
        return weight * pair / np.maximum(context, 1) + (1 - weight) * self.of_word(word, self.tokens)


def frequency(count: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: its number of binary digits."""
    return np.frexp(count.astype(np.float64))[1]


def _met(blocks: DataFrame, answers: DataFrame, counts: list[str], run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    needed = ["block", "ids", "learned", "sizes", "words", "tokens"]
    return blocks.select(*needed).groupBy("block").cogroup(answers.select("block", "kind", "part", *counts).groupBy("block")).applyInArrow(run, schema)


def learned_model(blocks: DataFrame, answers: DataFrame, parts: dict[str, int]) -> Model:
    """Totals, then the weights by expectation-maximisation on the deleted documents."""
    total = blocks.agg(*[F.coalesce(F.sum(F.when(F.col("deleted") | F.lit(every), F.col(c))), F.lit(0)).alias(f"{c}_{every}") for c in ("n_learned", "n_docs") for every in (True, False)]).first()
    own = answers.filter("kind = 'words'")
    model = Model(total["n_learned_True"], total["n_learned_False"], total["n_docs_True"], total["n_docs_False"], own.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("n")).first()["n"])
    summed = own.select(F.explode(F.arrays_zip("steps", "weights")).alias("x")).groupBy("x.steps").agg(F.sum("x.weights").alias("weight")).toPandas()
    model.word_weight = mixture_weight(summed["steps"].to_numpy(dtype=np.int64), summed["weight"].to_numpy(dtype=np.float64), (model.distinct + 1) / max(model.remaining, 1))

    def gather(block: pa.Table, found: pa.Table) -> pa.Table:
        counts = Counts(block, found, parts)
        word, context, pair = (c - d for c, d in zip(counts.of("c", model.documents[0]), counts.of("d", model.documents[1]), strict=True))
        seen = context > 0
        better = pair[seen] / context[seen] / model.of_word(word[seen], model.remaining)
        bucket, out = frequency(context[seen]), []
        for b in np.unique(bucket).tolist():
            steps, weights = histogram(better[bucket == b], np.ones(int((bucket == b).sum())))
            out.append(pa.table({"bucket": pa.array(np.full(len(steps), b, dtype=np.int32)), "step": pa.array(steps), "weight": pa.array(weights)}))
        return pa.concat_tables(out) if out else pa.table({"bucket": pa.array([], type=pa.int32()), "step": pa.array([], type=pa.int64()), "weight": pa.array([], type=pa.int64())})

    rows = _met(blocks.filter("deleted"), answers.filter("deleted"), ["c", "d"], gather, "bucket int, step long, weight long").groupBy("bucket", "step").agg(F.sum("weight").alias("weight")).toPandas()
    for bucket, own in rows.groupby("bucket"):
        model.pair_weights[int(bucket)] = mixture_weight(own["step"].to_numpy(dtype=np.int64), own["weight"].to_numpy(dtype=np.float64))
    return model


def _parts(spark: SparkSession, keys: int, part_keys: int) -> int:
    """Parts for so many keys: enough for all tasks, unless they are few."""
    return max(1, -(-keys // part_keys), min(int(spark.conf.get("spark.sql.shuffle.partitions")), keys * 10 // part_keys))


def scores(docs: DataFrame, may_learn: Column, delete: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """doc_id, held_out (not learned from), n_tokens, n_known (seen in training), train_tokens, base_score (words alone, one added to each count), score (log10 of the text's probability): one row a document.

    may_learn: what is learned from; delete: the part of it that the weights are fitted on."""
    spark, built = docs.sparkSession, blocks(docs, may_learn, delete, id_col, text_col, block_bytes)
    kind, path = built.schema["ids"].dataType.elementType.simpleString(), f"{shared_dir(spark)}/lm-blocks-{uuid.uuid4().hex}"
    # a row is a block: pages and row groups are checked at each of them
    built.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1).parquet(path)
    built = spark.read.schema(built.schema).parquet(path)
    size = built.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
    parts = {"words": _parts(spark, size["words"], part_keys), "pairs": _parts(spark, size["tokens"], part_keys)}
    answers = staged(answered(asked(built, parts["words"], False)).unionByName(answered(asked(built, parts["pairs"], True))), "lm-answers")
    model = learned_model(built, answers, parts)

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        counts = Counts(block, found, parts)
        (word, context, pair), m = counts.of("c", model.documents[0]), len(counts.sizes)
        total = lambda values: np.bincount(counts.row, weights=values, minlength=m)
        base = np.log10((word + 1) / (model.tokens + model.distinct + 1))
        mixed = np.log10(model.of_pair(pair, context, word))
        ids, learned = _whole(block, "ids").flatten(), _whole(block, "learned").flatten()
        return pa.table({"doc_id": ids, "held_out": pc.invert(learned), "n_tokens": pa.array(counts.sizes), "n_known": pa.array(total(word > 0).astype(np.int64)), "train_tokens": pa.array(np.full(m, model.tokens, dtype=np.int64)), "base_score": pa.array(total(base)), "score": pa.array(total(mixed))})

    return _met(built, answers, ["c"], score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
