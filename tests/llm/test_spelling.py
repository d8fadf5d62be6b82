import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from guideloom.llm import spelling

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(docs, drop_every, min_letters=5, min_count=3):
    counts = {}
    for i, text in docs:
        for run in LETTERS.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(counts, ratio=2):
    """The same by comparing all pairs."""
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def got(rows):
    return sorted(tuple(r) for r in rows.select("word", "form", "root", "n", "n_near", "form_n").collect())


def close_words(n, seed, letters="abcéÿ×", least=5, most=8):
    r = random.Random(seed)
    return ["".join(r.choices(letters, k=r.randint(least, most))) for _ in range(n)]


def test_counts_equal_plain_loops(spark, frame):
    r = random.Random(1)
    words = close_words(60, 2, "abCDéÉÿ×", 1, 9) + ["x" * 90, "é" * 70]
    texts = [" ".join(r.choices(words, k=80)) + r.choice(["", " it's Āă é́ naïve—Ünïcödé1abc", "¿Àx"]) for _ in range(120)] + [None, "", "1 2 3"]
    ids = [*range(119), 7, None, None, 3]
    docs = frame(texts, ids=ids)
    for every in (None, 97, 3):
        rows = {x["word"]: x["n"] for x in spelling.word_counts(docs, every).collect()}
        assert rows == plain_counts(list(zip(ids, texts, strict=True)), every) and rows


def test_checksums_of_joined_bytes():
    heads, tails = [b"", b"1:", b"123456:"], [b"", b"a", b"ab" * 30, b"c" * 64, b"d" * 65, b"e" * 200]
    row, code = (x.reshape(-1) for x in np.meshgrid(np.arange(3), np.arange(6)))
    assert spelling.joint_checksums(heads, row, tails, code).tolist() == [zlib.crc32(heads[r] + tails[c]) for r, c in zip(row, code, strict=True)]


@pytest.mark.parametrize("word", ["aaaaa", "abcba", "aabbc", "é", ""])
def test_neighbourhood_is_whole_and_distinct(word):
    alphabet = "abcé"
    wanted = {word[:k] + word[k + 1 :] for k in range(len(word))} | {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in alphabet if c != word[k]} | {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in alphabet}
    points = np.array([[ord(c) for c in word]], dtype=np.uint32).reshape(1, len(word))
    made, sums = [], []
    for kind, k, rows, which, h in spelling.neighbourhood(points, np.array([ord(c) for c in alphabet], dtype=np.uint32)):
        made += [word[:k] + ("" if kind == "delete" else alphabet[c]) + word[k if kind == "insert" else k + 1 :] for c in which.tolist()]
        sums += h.tolist()
        assert len(rows) == len(which) == len(h)
    assert len(made) == len(set(made)) and set(made) == wanted
    for text, h in zip(made, sums, strict=True):
        assert h == int(spelling.hashes(np.array([[ord(c) for c in text]], dtype=np.uint32).reshape(1, len(text)))[0])


def test_groups_equal_all_pairs(spark):
    r = random.Random(4)
    words = sorted(set(close_words(500, 5)))
    counts = {w: 3 * 2 ** r.choice([0, 0, 1, 1, 2, 3, 4, 5, 6, 7]) for w in words} | {words[0]: 10**12}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    wanted = plain_groups(counts)
    assert got(spelling.grouped(table)) == wanted
    assert got(spelling.grouped(table, max_filter_bytes=512)) == wanted  # in several passes
    assert any(r[2] != r[1] and r[1] for r in wanted)


def test_long_words_and_long_chains(spark):
    long = ["w" * 3000, "w" * 3001, "w" * 2999 + "v"]
    chain = ["abcdefgh", "abcdefgi", "abcdefji", "abcdekji", "abcdlkji", "abcmlkji", "abnmlkji"]
    counts = {w: 3 * 2**k for k, w in enumerate(chain)} | {w: 3 + k for k, w in enumerate(long)}
    rows = got(spelling.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == plain_groups(counts) and [r[2] for r in rows if r[0] == chain[0]] == [chain[-1]]


def test_odd_tables(spark, frame):
    assert got(spelling.grouped(spelling.word_counts(frame([]), 97))) == []
    assert got(spelling.grouped(spelling.word_counts(frame([None, "", "12"]), 97))) == []
    same = frame(["alpha betaé alphas"] * 5, ids=[1] * 5)
    assert got(spelling.grouped(spelling.word_counts(same))) == [("alpha", None, "alpha", 5, 1, None), ("alphas", None, "alphas", 5, 1, None), ("betaé", None, "betaé", 5, 0, None)]


def test_batches_of_words_by_length():
    words = pa.array(["a", "bc", "d", "éf", ""])
    parts = {tuple(where.tolist()): points.tolist() for where, points in spelling.by_length(words)}
    assert parts == {(4,): [[]], (0, 2): [[97], [100]], (1, 3): [[98, 99], [233, 102]]}
