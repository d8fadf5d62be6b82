import hashlib
import random

import numpy as np

from guideloom.llm import suffix_dedup


def brute(texts, span=100):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if raw[i : i + span] in seen:
                gone[i : i + span] = b"\1" * span
            seen.add(raw[i : i + span])
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def corpus(prose, seed=1):
    r = random.Random(seed)
    passages = [prose(n, 50 + n) for n in (15, 17, 20, 40, 200)]
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 350, "ab" * 200, "x" + "ab" * 70, "été €" * 60, passages[2][:100], passages[2][:99]]
    for k in range(60):
        parts = [prose(r.randint(1, 60), 1000 + k)]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(len(p))
            parts += [p[a : a + r.randint(60, 400)], prose(r.randint(1, 9), 2000 + r.randrange(999))]
        texts.append(r.choice([" ", "\n", "é\x00"]).join(parts))
    texts += [texts[-1], texts[-2] + "\n" + texts[-3], passages[4], passages[4]]
    r.shuffle(texts)
    return texts


def run(docs, **options):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.without_repeats(docs, **options).collect()}


def test_as_by_brute_force(frame, prose, monkeypatch):
    texts = corpus(prose)
    expected = dict(enumerate(brute(texts)))
    assert run(frame(texts)) == expected
    monkeypatch.setattr(suffix_dedup, "STEP_ROWS", 37)
    assert run(frame(texts)) == expected


def test_groups_across_batches(spark, frame, prose):
    texts = corpus(prose, 2) * 2
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert run(frame(texts)) == dict(enumerate(brute(texts)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_groups_are_cut(frame, prose, monkeypatch):
    """Groups of more than three rows go by the bytes around the anchor, down to single places."""
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 3)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 2)
    for seed in (3, 4):
        texts = corpus(prose, seed)
        assert run(frame(texts)) == dict(enumerate(brute(texts)))


def test_an_anchor_in_very_many_places(frame, monkeypatch):
    """A line of 60 bytes that stands in 20000 texts between others, now and then with what was around it before."""
    r = random.Random(8)
    line = "".join(r.choices("abcdefgh", k=60))
    texts, letters = [], "abcdefghijklmnop"
    for k in range(20_000):
        left, right = "".join(r.choices(letters, k=44)), "".join(r.choices(letters, k=44))
        if k % 50 == 1:
            left = texts[-1][:44]
        if k % 70 == 2:
            right = texts[-1][-44:]
        texts.append(left + line + right)
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 4096)
    found = []
    original = suffix_dedup.smaller_groups
    monkeypatch.setattr(suffix_dedup, "smaller_groups", lambda *a: found.append(1) or original(*a))
    got = run(frame(texts))
    assert found and got == dict(enumerate(brute(texts))) and sum(g[1] > 0 for g in got.values()) > 500


def test_steps_find_the_same_anchors(prose):
    raw = np.frombuffer((prose(3000, 5) + "ab" * 500).encode(), dtype=np.uint8)
    ends = np.array([700, 720, 5000, len(raw)])
    whole = suffix_dedup.text_anchors(raw, ends)
    for step in (150, 1000):
        parts = suffix_dedup.text_anchors(raw, ends, step=step)
        assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_deep_shallow_orders():
    r = random.Random(3)
    strings = [bytes(r.choices(b"ab", k=r.randint(0, 40))) for _ in range(300)] + [b"q" * 30 + bytes([c]) * 3 for c in b"zyxyz"]
    lengths = np.array(list(map(len, strings)))
    rows = np.zeros((len(strings), 48), dtype=np.uint8)
    for k, s in enumerate(strings):
        rows[k, : len(s)] = list(s)
    group = np.array([k % 3 for k in range(len(strings))])
    order = suffix_dedup.deep_shallow(group, rows, lengths, 0, 8)
    # behind shared bytes, and behind bytes that are wrongly said to be shared
    for common, shallow in ((8, 8), (8, 24)):
        lead = np.where((group == 2)[:, None], rows[:, :8], 7)
        assert suffix_dedup.deep_shallow(group, np.concatenate([lead, rows], axis=1), lengths + 8, common, shallow).tolist() == suffix_dedup.deep_shallow(group, np.concatenate([lead, rows], axis=1), lengths + 8, 0, 48).tolist()
    assert [(group[k], strings[k]) for k in order] == sorted((group[k], strings[k]) for k in range(len(strings)))


def test_odd_tables(frame, prose):
    assert run(frame([])) == {}
    text = prose(100)
    same = suffix_dedup.without_repeats(frame([text, text, None, text + "!"], ids=[3, 3, None, None])).collect()
    got = sorted((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in same)
    n = len(text)
    assert got == [(False, n, 0), (False, n, 0), (True, 0, 0), (True, n + 1, n)]
    kept = suffix_dedup.without_repeats(frame([text, text[:50] + text]), with_text=True).collect()
    assert {r["doc_id"]: r["kept"] for r in kept}[1] == text[:50].encode()
