import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from guideloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["ΣΑΣ ΌΣ", "İstanbul STRASSE straße", "it's don't'll", "日本語 テキスト", "😀😀 a​b", "x² ½ Ⅷ", "́abc a\x1cb", "<|endoftext|> text", "x<|startoftext|>y <|endoftext|>", "<|ENDOFTEXT|> \n<|endoftext|>\té<|endoftext|>日本", "foo\xa0bar", "l’été", "a\x00b", "été"]


def brute_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_as_by_the_library(frame, prose):
    texts = [None, "", " \n", *ODD, prose(50), prose(9000, 3), "!!! ... ,,, 123 4a5"]
    rows = packing.pack(packing.pieces(frame(texts), with_ids=True)).collect()
    docs = defaultdict(dict)
    for r in rows:
        docs[r["doc_id"]][r["piece"]] = r
    for k, text in enumerate(texts):
        ids = brute_ids(text)
        assert len(docs[k]) == math.ceil(len(ids) / 4096)
        for p, r in docs[k].items():
            own = ids[4096 * p : 4096 * (p + 1)]
            assert r["ids"] == own and r["start"] == 4096 * p and r["length"] == len(own)
            assert r["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())


def check(rows, capacity):
    used = defaultdict(list)
    for sequence, offset, length in rows:
        used[sequence].append((offset, length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80), st.integers(1, 8))
def test_best_fit_keeps_its_bounds(lengths, open_bins):
    sequence, offset = packing.best_fit(lengths, 64, open_bins)
    check(zip(sequence, offset, lengths), 64)
    # plain version: a list of open bins, the fullest that fits, the fullest closed first
    free, count = {}, 0
    for n in lengths:
        fit = [f for f in free.values() if f >= n]
        if fit:
            b = next(k for k, f in free.items() if f == min(fit))
        else:
            if n < 64 and len(free) == open_bins:
                free.pop(next(k for k, f in free.items() if f == min(free.values())))
            b, count = count, count + 1
            free[b] = 64
        free[b] -= n
        if not free[b]:
            free.pop(b)
    assert count == len(set(sequence))


def test_few_sequences(frame, prose):
    r = random.Random(1)
    docs = frame([prose(r.randint(1, 900), k) for k in range(300)])
    rows = packing.pack(packing.pieces(docs), bucket_pieces=100).collect()
    total = sum(r["length"] for r in rows)
    assert len(rows) == 300
    assert check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 4096) <= total / 4096 * 1.05 + 8


def test_the_fullest_closes_first(spark):
    """Through pack, with the bound it has in production: more sequences than may be open cannot be filled up later, and those closed are the fullest."""
    r = random.Random(2)
    large = [r.randint(2100, 4000) for _ in range(3000)]
    rows = [(k, 0, 0, n, k) for k, n in enumerate(large)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").coalesce(1)
    out = packing.pack(cut, bucket_pieces=10**6).collect()
    check([(x["sequence_id"], x["offset"], x["length"]) for x in out], 4096)
    assert len({x["sequence_id"] for x in out}) == 3000  # no two fit together
    # 3000 large pieces, then as many that fit beside the emptiest only
    sequence, _ = packing.best_fit([*large, *[96] * 3000], 4096)
    used = {s for s in sequence[3000:] if s < 3000}
    emptiest = sorted(range(3000), key=lambda k: large[k])[: packing.OPEN_BINS]
    assert 0 < len(used) <= packing.OPEN_BINS and used - {2999} <= set(emptiest)  # the last was opened after the last closing


def test_ids_of_every_document_as_by_the_library():
    texts = [r[0] for r in duckdb.execute("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    whole = Tokenizer.from_file(PATH)
    sizes, ids = packing.document_ids(pa.array(texts, type=pa.string()).fill_null(""), PATH)
    for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert own.tolist() == whole.encode(text or "", add_special_tokens=False).ids + [1]


def test_odd_tables(frame):
    assert packing.pack(packing.pieces(frame([]))).collect() == []
    rows = packing.pack(packing.pieces(frame(["a", "a", None], ids=[1, 1, None]))).collect()
    assert sorted(r["length"] for r in rows) == [1, 2, 2] and len({r["sequence_id"] for r in rows}) == 1


def test_rows_that_share_an_id_are_dealt_out(frame):
    rows = packing.pack(packing.pieces(frame(["a b"] * 400, ids=[None] * 400)), bucket_pieces=50).collect()
    check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 4096)
    assert len(rows) == 400 and len({r["sequence_id"] >> 32 for r in rows}) == 8
