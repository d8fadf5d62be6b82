import random
import re

import numpy as np
from pyspark.sql import functions as F

from guideloom.llm import near_dedup


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(texts, width, percent, ids=None):
    ids = ids or list(range(len(texts)))
    sets, root = [shingles(t, width) for t in texts], list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k in range(len(texts)):
        least[find(k)] = min(least.get(find(k), ids[k]), ids[k])
    return [(len(sets[k]), least[find(k)]) for k in range(len(texts))]


def corpus(prose, seed=4):
    r = random.Random(seed)
    passage = prose(60, 99)
    texts = [None, "", " ", "one", "One", "one two", "two one"]
    for k in range(12):
        words = prose(r.choice([20, 90, 160, 400]), 100 + k).split()
        texts.append(" ".join(words))
        for _ in range(r.randint(0, 14)):
            edited = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                edited[r.randrange(len(edited))] = "new%d" % r.randrange(10**6)
            texts.append(" ".join(edited[: len(edited) - r.choice([0, 0, len(edited) // 12])]))
    for k in range(40):  # a passage that many texts share, at different shares of them
        texts.append(passage + " " + prose(r.randint(4, 80), 500 + k))
    r.shuffle(texts)
    return texts


def test_groups_as_by_brute_force(frame, prose):
    texts = corpus(prose)
    for width, percent, k in ((3, 85, 128), (5, 80, 128), (3, 85, 64)):
        rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(frame(texts), width, percent, k).collect()}
        expected = brute(texts, width, percent)
        assert [(rows[i]["n_shingles"], rows[i]["component_id"]) for i in range(len(texts))] == expected
        assert all(rows[i]["kept"] == (rows[i]["component_id"] == i) for i in rows)


def test_long_lists_as_by_brute_force(frame, prose, monkeypatch):
    """Lists of more than two classes go by differences from a head, through several levels."""
    monkeypatch.setattr(near_dedup, "MAX_LISTED", 2)
    for seed, width, percent in ((4, 3, 85), (5, 3, 60)):
        texts = corpus(prose, seed)
        rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(frame(texts), width, percent).collect()}
        assert [(rows[i]["n_shingles"], rows[i]["component_id"]) for i in range(len(texts))] == brute(texts, width, percent)


def copies(words, n, edits, seed, vocabulary=500):
    """Copies of a text with some words replaced, by words that others may get too."""
    r, out = random.Random(seed), []
    for _ in range(n):
        edited = list(words)
        for _ in range(r.randint(*edits)):
            edited[r.randrange(len(edited))] = "other%d" % r.randrange(vocabulary)
        out.append(" ".join(edited))
    return out


def components_of(texts, width, percent):
    """By a matrix of all overlaps."""
    sets = [shingles(t, width) for t in texts]
    number = {x: k for k, x in enumerate(set().union(*sets))}
    held = np.zeros((len(sets), len(number)), dtype=np.float32)
    for k, s in enumerate(sets):
        held[k, [number[x] for x in s]] = 1
    common, size = held @ held.T, held.sum(axis=1)
    linked = 100 * common >= percent * (size[:, None] + size[None] - common)
    label = np.arange(len(sets))
    while True:
        low = np.array([label[row].min() for row in linked])
        if (low == label).all():
            return label.tolist()
        label = low


def test_many_copies_short_of_the_threshold(frame, prose):
    """2000 copies of a text that is not there, most of them too far from each other: no pairs within the group, the same groups."""
    words = prose(150, 31).split()
    for edits in ((2, 6), (4, 12)):
        texts = copies(words, 2000, edits, 32)
        rows = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(texts), 3, 85).collect()}
        assert [rows[k] for k in range(len(texts))] == components_of(texts, 3, 85)


def test_pairs_of_a_group_grow_with_its_size(spark, prose):
    words = prose(150, 31).split()
    made = []
    for n in (300, 1200):
        sets = [sorted(hash(x) for x in shingles(t, 3)) for t in dict.fromkeys(copies(words, n, (4, 12), 33))]
        full = spark.createDataFrame(list(enumerate(sets)), "node long, values array<bigint>").cache()
        live = full.select("node", F.size("values").alias("n"), F.col("node").alias("label"))
        links, pairs = near_dedup.pairs_across(live, full, 85, 32)
        made.append(links.count() + pairs.count())
    assert made[1] < 6 * max(made[0], 300)


def test_chain_and_long_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 105), (105, 103)], "a long, b long")
    labels = dict(near_dedup.components(edges).collect())
    assert labels == {i: 0 for i in range(61)} | {100: 100, 103: 100, 105: 100}


def test_shuffled_path(frame, prose, monkeypatch):
    monkeypatch.setattr(near_dedup, "MAX_BROADCAST_IDS", 0)
    words = prose(400, 7)
    docs = frame([words, prose(300, 8), words + " more", None])
    assert sorted(r["doc_id"] for r in near_dedup.one_of_each(docs).collect()) == [0, 1, 3]


def test_odd_tables(frame, prose):
    assert near_dedup.near_duplicates(frame([])).collect() == [] == near_dedup.one_of_each(frame([])).collect()
    text = prose(80)
    rows = near_dedup.near_duplicates(frame([text, text, text, None], ids=[5, 5, None, None])).collect()
    assert [r["component_id"] for r in rows if r["n_shingles"]] == [5, 5, 5]
    long = prose(400, 3)
    rows = near_dedup.near_duplicates(frame([long, long + " more", prose(300, 4)], ids=[None, None, 3]), 3, 85).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in rows) == [(False, 3), (True, None), (True, None)]
    assert near_dedup.one_of_each(frame([long, long + " more", None], ids=[None, None, None])).count() == 2
    # rows that share an id: only the copy goes
    assert sorted(r["text"] for r in near_dedup.one_of_each(frame([text, text + " x", long], ids=[1, 2, 2])).collect()) == sorted([text, long])
    docs = frame([text, text, text + " x", "other words"], ids=[5, 5, 9, 7])
    out = near_dedup.one_of_each(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [5, 7]


def test_rows_without_words_stay_whatever_repeats(spark, frame, prose):
    text = prose(40)
    empty = [(7, ""), (7, ""), (None, ""), (None, ""), (8, None), (8, None)]
    for linked, left in (([(1, text), (2, text)], [1]), ([(1, text), (1, text)], [1]), ([(1, text), (1, text), (2, text)], [1]), ([(None, text), (None, text)], [None])):
        rows = [*empty, *linked]
        out = near_dedup.one_of_each(frame([t for _, t in rows], ids=[i for i, _ in rows]))
        got = sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=repr)
        assert got == sorted([*empty, *[(i, text) for i in left]], key=repr)
