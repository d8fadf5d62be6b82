import re
from collections import defaultdict

import pytest

from guideloom.llm import mixing


def brute_targets(sizes, share=1.5, epochs=2.0, cycle=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if w and left * weight[s] / w > epochs * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: epochs * sizes[s] for s in over}


def table(prose, n=600):
    texts, sources = [], []
    for k in range(n):
        texts.append([None, "", " \t\n", prose(k % 90 + 1, k)][min(k % 50, 3)])
        sources.append([None, "a", "b", "é", "hot", "hot", "hot"][k % 7])
    return texts, sources


def test_targets_and_taken(frame, prose):
    texts, sources = table(prose)
    docs = frame(texts, sources=sources)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts)
    sizes = defaultdict(int)
    for t, s in zip(texts, sources):
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    expected, taken = brute_targets(sizes), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 90
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, map(lambda r: (r["doc_id"], r["taken"]), rows))) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_many_buckets(frame, prose, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    texts, sources = table(prose)
    taken, target = defaultdict(int), {}
    for r in mixing.mix(frame(texts, sources=sources)).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 90 for s in target)


def test_documents_are_repeated(frame, prose):
    texts, sources = table(prose, 200)
    docs = frame(texts, sources=sources)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r["doc_id"]] += 1
        assert r["draw"] == 0.5 and r["text"] == texts[r["doc_id"]]
    assert seen == {k: v for k, v in copies.items() if v}


def test_odd_tables(frame):
    assert mixing.mix(frame([])).collect() == []
    only = mixing.mix(frame([None, ""], sources=[None, None])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0), (0, 0.0, 0)]
    twice = mixing.mix(frame(["a b c"] * 4, ids=[1, 1, None, None], sources=list("aabb"))).collect()
    assert len(twice) == 4 and len({(r["doc_id"], r["taken"]) for r in twice}) == 2


def test_sources_of_shared_or_missing_ids_come_near_their_targets(frame, prose):
    n = 150
    texts = [prose(20 + k % 30, k) for k in range(3 * n)]
    ids = list(range(n)) + [7] * n + [None] * n
    docs = frame(texts, sources=["a"] * n + ["b"] * n + ["c"] * n, ids=ids)
    taken, target = defaultdict(int), {}
    rows = mixing.plan_mix(docs, cycle=(1, 1, 1))
    for r in mixing.mix(docs, cycle=(1, 1, 1)).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in "abc") and rows
    assert sorted(r["text"] for r in mixing.mixed_documents(docs, cycle=(1, 1, 1)).collect()) == sorted(r["text"] for r in mixing.mixed_documents(docs.repartition(5), cycle=(1, 1, 1)).collect())
