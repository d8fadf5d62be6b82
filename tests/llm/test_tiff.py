import hashlib
import resource
import itertools
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from guideloom.llm import tiff


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=3000) | st.lists(st.sampled_from([b"a", b"bb", b"c" * 200, b"\xff\0"]), max_size=60).map(b"".join))
def test_codecs_give_back_what_they_took(data):
    assert tiff.unpackbits(tiff.packbits(data), len(data)) == data
    assert tiff.unlzw(tiff.lzw(data), len(data)) == data


def test_long_lzw():
    data = np.random.default_rng(1).integers(0, 7, 60000).astype(np.uint8).tobytes() + b"x" * 70000
    assert tiff.unlzw(tiff.lzw(data), len(data)) == data
    assert tiff.unlzw(bytes([0x80, 0x0B, 0x60, 0x50, 0x22, 0x0C, 0x0C, 0x85, 0x01]), 10) == bytes([45, 45, 45, 45, 45, 65, 45, 45, 45, 66])  # the published example


@pytest.mark.parametrize("compression", ["none", "lzw", "deflate", "packbits"])
def test_pages_round_trip(compression):
    rng = np.random.default_rng(2)
    pages = [rng.integers(0, 256, (h, w, s)).astype(np.uint8) // 16 for h, w, s in ((1, 1, 1), (33, 50, 3), (100, 17, 1), (16, 16, 4))]
    for predictor, tile, order, planar in itertools.product((False, True), (None, (16, 16), (32, 16)), "<>", (False, True)):
        data = tiff.write_tiff(pages, compression, predictor, tile, 7, order, planar)
        back = list(tiff.read_pages(data))
        assert len(back) == len(pages) and all(np.array_equal(a, b) for a, b in zip(pages, back))


def test_page_rows(spark):
    page = np.arange(12, dtype=np.uint8).reshape(3, 4, 1)
    good = tiff.write_tiff([page, page + 1], "packbits")
    loop = bytearray(good)
    files = spark.createDataFrame([(1, good, "x"), (2, None, "x"), (3, b"nonsense", "x"), (4, good[:40], "x"), (1, good, "x"), (5, bytes(loop[:4]) + b"\xff\xff\0\0" + bytes(loop[8:]), "x")], "file_id long, data binary, page string")
    rows = tiff.tiff_pages(files).collect()
    assert sorted((r["page"], bytes(r["pixels"])) for r in rows if r["file_id"] == 1) == [(0, page.tobytes())] * 2 + [(1, (page + 1).tobytes())] * 2
    assert all(r["page"] is None and r["error"] for r in rows if r["file_id"] != 1) and len(rows) == 8
    assert tiff.tiff_pages(files.limit(0)).collect() == []


def directory(tags, tail=b""):
    """A file of one directory of tags (tag, value) of 32 bits, and bytes behind it."""
    entries = b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in sorted(tags.items()))
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0" + tail


def test_broken_files_give_an_error_row(spark):
    flat = {256: 4, 257: 3, 258: 8, 259: 1, 273: 300, 277: 1, 278: 3, 279: 12, 284: 1}
    bomb = zlib.compress(b"\0" * 5_000_000)
    bad = [
        flat | {277: 0, 284: 2}, flat | {284: 3}, flat | {256: 400_000, 257: 400_000}, flat | {256: 0}, flat | {278: 0, 257: 0}, flat | {279: 2}, flat | {273: 10**9}, flat | {259: 7}, flat | {258: 16},
        flat | {259: 5}, flat | {259: 8}, flat | {317: 9}, flat | {322: 1 << 30, 323: 1 << 30, 324: 300, 325: 12}, flat | {322: 0, 323: 0, 324: 300, 325: 12},
    ]
    good = tiff.write_tiff([np.zeros((4, 4, 1), dtype=np.uint8)], "deflate")
    raw = [directory(t, b"\xff" * 400) for t in bad] + [b"", b"II*\0", b"II*\0\0\0\0\0", b"MM\0*\0\0\0\x08\xff\xff", good[:-3], good[:30]]
    files = spark.createDataFrame([(k, x) for k, x in enumerate(raw)] + [(100, directory(flat | {259: 8, 273: 300, 279: len(bomb)}, b"\0" * (300 - len(directory(flat))) + bomb)), (101, directory(flat, bytes(400)))], "file_id long, data binary")
    rows = {r["file_id"]: r for r in tiff.tiff_pages(files).collect()}
    assert len(rows) == len(raw) + 2
    assert all(r["error"] and r["page"] is None for k, r in rows.items() if k < 100)
    assert bytes(rows[100]["pixels"]) == bytes(rows[101]["pixels"]) == bytes(12)  # a bomb is unpacked as far as the page goes


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_no_damage_breaks_the_reader(data):
    page = np.arange(600, dtype=np.uint8).reshape(20, 30, 1)
    raw = bytearray(tiff.write_tiff([page, page], *data.draw(st.sampled_from(tiff.FORMS))))
    for _ in range(data.draw(st.integers(1, 6))):
        raw[data.draw(st.integers(0, len(raw) - 1))] = data.draw(st.integers(0, 255))
    try:
        for k, p in enumerate(tiff.read_pages(bytes(raw))):
            assert p.size and k < 1000
    except tiff.BROKEN:
        pass


@pytest.mark.parametrize("forms", [tiff.FORMS, *[[f] for f in tiff.FORMS]])
def test_texts_are_stored_whole(frame, prose, forms):
    texts = [None, "", "é" * 288, "é" * 288 + "x", prose(300), prose(9000), prose(300), "\x00\xff", *[prose(9, k) for k in range(60)]]
    rows = {r["doc_id"]: r for r in tiff.store_and_read(frame(texts), forms).collect()}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload)) and len(payload) % 576 == 0 and payload
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-32:])
        image = np.frombuffer(payload, dtype=np.uint8).reshape(-1, 576)
        runs = sum(a == b for row in image.tolist() for a, b in zip(row, row[1:]))
        pages = -(-len(image) // 1024)
        assert r["feature"] == f"pages={pages};rows={len(image)};mean={sum(payload) / len(payload):.4f};max={max(payload)};runs={runs / len(payload):.4f}"
        media = tiff.write_tiff([image[a : a + 1024, :, None] for a in range(0, len(image), 1024)], *forms[zlib.crc32(payload) % len(forms)])
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
    assert rows[4][1:] == rows[6][1:] and rows[0][1:] == rows[1][1:]
    assert len({zlib.crc32((t or "").encode()) % 8 for t in texts}) == 8
    assert tiff.store_and_read(frame([])).collect() == []


def chained(strip, side, n, own=False):
    """A file of n directories over one strip (or a copy of it each), deflated, of side x side samples."""
    out, link = bytearray(b"II*\0" + bytes(4)), 4
    for k in range(n):
        if own or not k:
            place = len(out)
            out += strip + b"\0" * (len(strip) & 1)
        struct.pack_into("<I", out, link, len(out))
        tags = [(256, side), (257, side), (258, 8), (259, 8), (273, place), (277, 1), (278, side), (279, len(strip))]
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags)
        link = len(out)
        out += bytes(4)
    return bytes(out)


def test_many_pages_over_one_strip(spark):
    strip = zlib.compress(bytes(3200 * 3200))
    shared, own = chained(strip, 3200, 1000), chained(zlib.compress(b"\1" * 100), 10, 300, own=True)
    began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pages = list(map(lambda p: p[:3] + p[5:], tiff.pages_or_error(shared)))
    assert pages[0][1:] == (3200, 3200, None) and pages[-1][-1] == "page too large" and len(pages) < 4  # the strip holds little more than one page
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - began < 200_000  # kB
    assert len(list(tiff.read_pages(own))) == 300  # pages of their own are all read
    rows = tiff.tiff_pages(spark.createDataFrame([(1, own), (2, shared)], "file_id long, data binary")).groupBy("file_id").count().collect()
    assert {r["file_id"]: r["count"] for r in rows} == {1: 300, 2: len(pages)}


def test_directories_over_each_other():
    n = 3000  # entries of each directory, one every 16 bytes, the last of which link on
    raw = bytearray(b"II*\0" + struct.pack("<I", 8)) + struct.pack("<HHHI", 4000, 256, 3, 20_000) * n
    with pytest.raises(tiff.BROKEN):
        for _ in tiff.directories(bytes(raw)):
            pass

