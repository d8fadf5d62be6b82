import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from guideloom.llm import interpolation

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def best_weight(ratios):
    """The mixture weight by the same iteration, on the ratios themselves."""
    share = 0.5
    for _ in range(interpolation.ROUNDS if len(ratios) else 0):
        share = min(max(sum(share * r / (share * r + 1 - share) for r in ratios) / len(ratios), 1e-6), 1 - 1e-6)
    return share


def plain(docs):
    """The same by loops over dictionaries: sorted (doc_id, held_out, n_tokens, n_known, N, base, score)."""
    draw = lambda i: zlib.crc32(str("" if i is None else i).encode())
    held, gone = (lambda i: draw(i) % 7 == 2), (lambda i: draw(i) // 7 % 8 == 0)
    pairs = lambda t: list(zip(["begin", *t[:-1]], t, strict=True))
    words, remaining, both, both_remaining, context, context_remaining = (Counter() for _ in range(6))
    for i, text in docs:
        if held(i):
            continue
        t = tokens(text)
        words.update(t), both.update(pairs(t)), context.update(c for c, _ in pairs(t))
        if not gone(i):
            remaining.update(t), both_remaining.update(pairs(t)), context_remaining.update(c for c, _ in pairs(t))
    n, v, left = sum(words.values()), len(words), sum(remaining.values())
    deleted = [p for i, text in docs if not held(i) and gone(i) for p in pairs(tokens(text))]
    one = best_weight([remaining[w] / left * (v + 1) for _, w in deleted] if left else [0.0] * len(deleted))
    share = lambda c, total: one * c / total + (1 - one) / (v + 1) if total else 1 / (v + 1)
    by = {}
    for c, w in deleted:
        if context_remaining[c]:
            by.setdefault(context_remaining[c].bit_length(), []).append(both_remaining[c, w] / context_remaining[c] / share(remaining[w], left))
    weight = {b: best_weight(r) for b, r in by.items()}
    rows = []
    for i, text in docs:
        t, score = tokens(text), 0.0
        for c, w in pairs(t):
            lam = weight.get(context[c].bit_length(), 0.5) if context[c] else 0.0
            score += math.log10(lam * both[c, w] / max(context[c], 1) + (1 - lam) * share(words[w], n))
        rows.append((i, held(i), len(t), sum(words[w] > 0 for w in t), n, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in t), score))
    return sorted(rows, key=repr)


def got(docs, **options):
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = interpolation.scores(docs, draw % 7 != 2, F.floor(draw / 7) % 8 == 0, **options)
    return sorted([tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in rows.collect()], key=repr)


def same(ours, theirs):
    assert [r[:5] for r in ours] == [r[:5] for r in theirs]
    assert [r[5] for r in ours] == pytest.approx([r[5] for r in theirs], rel=1e-9)
    assert [r[6] for r in ours] == pytest.approx([r[6] for r in theirs], rel=2e-4)


def chain(n, seed):
    """Words that depend on the word before."""
    r, words = random.Random(seed), ["Aa", "b", "cé", "D.", "e", "f"]
    out = [r.choice(words)]
    while len(out) < n:
        out.append(words[(words.index(out[-1]) + r.choice([1, 1, 1, 2])) % 6] if out[-1] in words and r.random() < 0.95 else r.choice([*words, f"rare{r.randrange(40)}"]))
    return r.choice(["", " ", "\n"]) + r.choice([" ", "\t\n"]).join(out)


def test_equals_plain_loops_whatever_the_blocks(spark, frame):
    texts = [chain(k % 60 + 1, k) for k in range(200)] + [None, "", "  ", "zz yy xx", chain(3000, 5), "same text", "same text", "   x"]
    ids = [*range(len(texts) - 3), 4, None, None]
    docs, wanted = frame(texts, ids=ids).repartition(3), plain(list(zip(ids, texts, strict=True)))
    same(got(docs), wanted)
    same(got(docs, block_bytes=500, part_keys=100), wanted)
    assert sum(r[6] for r in wanted if r[1]) > 1.3 * sum(r[5] for r in wanted if r[1])  # (both are negative) pairs help with texts that were not learned from


def test_nothing_to_learn_from(spark, frame):
    out = {i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 2}
    docs = frame(["a b"] * len(out), ids=sorted(out))
    rows = got(docs)
    assert rows == [(i, True, 3, 0, 0, 0.0, 0.0) for i in sorted(out, key=lambda i: repr((i, True)))]
    assert got(frame([])) == []


def test_the_mixture_sums_to_one():
    model = interpolation.Model(1000, 100, 50, 5, 3)
    model.word_weight, model.pair_weights = 0.7, np.linspace(0, 0.9, 65)
    words, pairs = np.array([500, 300, 200, 0]), np.array([30, 10, 0, 0])
    for context in (40, 0):
        assert model.of_pair(pairs * (context > 0), np.full(4, context), words).sum() == pytest.approx(1)


def test_weights_follow_the_held_out_events():
    steps, weights = interpolation.histogram(np.array([0.0, 4.0, 4.0]), np.array([50, 25, 25]))
    assert interpolation.mixture_weight(steps, weights) == pytest.approx(best_weight([0.0] * 50 + [4.0] * 50), rel=1e-2)
    assert interpolation.mixture_weight(np.zeros(0, int), np.zeros(0)) == 0.5
    assert interpolation.mixture_weight(*interpolation.histogram(np.array([9.0]), np.array([5]))) == 1 - 1e-6


def test_beginnings_of_documents():
    assert interpolation.contexts(np.array([1, 2, 0, 0, 3, 0]), np.array([3, 1, 2]), 4).tolist() == [4, 1, 2, 4, 4, 3]
