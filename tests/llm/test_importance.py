import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from guideloom.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, n):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n, buckets=50, min_words=20, percent=10):
    """The same by loops: sorted (doc_id, n_features, weight, score, rank)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for texts, into in ((t_ for _, t_ in docs), s), (iter(target), t):
        for text in texts:
            for f in features(text, n):
                into[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (s.sum() + buckets) / ((float(s[b]) + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        own = features(text, n)
        weight = sum(gain[bucket(f)] for f in own)
        rows.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted([(*r[:4], rank.get(id(r))) for r in rows], key=repr)


def got(rows):
    return sorted([tuple(r) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_equals_plain_loops_whatever_the_chunks(spark, frame, prose, n):
    texts = [prose(k * 7 % 90, seed=k % 20, vocabulary=30) for k in range(120)] + [None, "", "  ", "É1 é1 É1-x'y", "word " * 300, "word " * 300, "x" * 5000, prose(2000, seed=3, vocabulary=25).upper()]
    ids = [*range(len(texts) - 3), 5, None, None]
    target = [prose(40, seed=2, vocabulary=30), None, "É1 é1"]
    docs, wanted = frame(texts, ids=ids), plain(list(zip(ids, texts, strict=True)), target, n)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(importance.resample(docs, goal, n=n, buckets=50)) == wanted
    for size in (1, 7, 64):  # every longer text in chunks
        assert got(importance.resample(docs, goal, n=n, buckets=50, long_bytes=100, chunk_words=size)) == wanted
    assert sum(r[4] is not None for r in wanted) > 5


def test_chunks_own_their_starts():
    text = pa.array(["  ab c  de f g "])
    chunks, owned = importance.chunks_of(text, 3, 2)
    assert chunks.to_pylist() == ["ab c  de f", "de f g", "g"] and owned.tolist() == [2, 2, 1]
    assert importance.chunks_of(pa.array(["   "]), 2, 4)[0].to_pylist() == [""]


def test_rows_that_share_id_and_text(spark, frame):
    goal = spark.createDataFrame([("a b",)], "text string")
    docs = frame(["a b c " * 20] * 30 + ["d e " * 40] * 10, ids=[1] * 30 + [2] * 10)
    for bytes_ in (20, 1 << 19):
        rows = got(importance.resample(docs, goal, buckets=50, long_bytes=bytes_, chunk_words=9))
        assert [r[1] for r in rows] == [60] * 30 + [80] * 10 and sorted(r[4] for r in rows if r[4]) == [1, 2, 3, 4]


def test_drawn_documents(spark, frame, prose):
    texts = [prose(60, seed=k) for k in range(50)] + ["short", None]
    docs = frame(texts, ids=[*range(50), 3, None])
    goal = spark.createDataFrame([(texts[7],)], "text string")
    drawn = importance.drawn_documents(docs, goal)
    rows = drawn.collect()
    assert drawn.columns == docs.columns and len(rows) == 5 and all(r["text"] == texts[r["doc_id"]] for r in rows)
    assert 7 in {r["doc_id"] for r in rows}  # the target's own text weighs most


def test_odd_tables(spark, frame):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(frame([]), none).count() == 0
    assert got(importance.resample(frame([None, ""]), none)) == plain([(0, None), (1, "")], [], 1, 10_000)
