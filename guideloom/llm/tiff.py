"""TIFF columns: a reader that walks image directories, and a writer to store bytes as pages.

The reader takes little- and big-endian files, strips and tiles, 8-bit samples, chunky or
planar, without compression or with PackBits, LZW or deflate, and undoes the horizontal
predictor. It gives one row a page, in the order of the directories.

Defined cases: null files and files without a page give one row with page null and an
error; a broken file gives the pages before the fault and then such a row, and so does one
whose page is larger than a stated bound or than its data can hold; an empty
table gives no rows; each file is held by one task, one at a time; columns other than the
id and the file are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_arrow

#: Tag numbers and codes of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
CODES = {"none": 1, "lzw": 5, "deflate": 8, "packbits": 32773}
TYPES = {1: "B", 3: "H", 4: "I"}

PAGE_WIDTH, PAGE_ROWS, STRIP_ROWS = 576, 1024, 128
#: Largest page to unpack, in bytes.
MAX_PAGE_BYTES = 1 << 30
#: The forms in which texts are stored, by checksum: compression, predictor, size of tiles (none: strips).
FORMS = [("deflate", False, None), ("deflate", True, None), ("deflate", False, (192, 16)), ("deflate", True, (96, 32)), ("packbits", False, None), ("packbits", True, (288, 16)), ("lzw", True, None), ("lzw", False, (192, 16))]


class TiffError(ValueError):
    """The file is not one that this reader takes."""


#: What a damaged file may raise.
BROKEN = (TiffError, zlib.error, struct.error, IndexError, KeyError, ValueError, OverflowError, MemoryError)


def unpackbits(data: bytes, need: int) -> bytes:
    """Unpacked bytes, no more than one run beyond `need`."""
    out, at = bytearray(), 0
    while at < len(data) and len(out) < need:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + n + 2]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2 if n > 128 else 1
    return bytes(out)


def packbits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as repeats, the rest as literals."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return b""
    starts = np.flatnonzero(np.r_[True, raw[1:] != raw[:-1]])
    ends = np.r_[starts[1:], len(raw)]
    out, literal = bytearray(), 0

    def flush(upto: int) -> None:
        for a in range(literal, upto, 128):
            piece = data[a : min(a + 128, upto)]
            out.append(len(piece) - 1)
            out.extend(piece)

    for start, end in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
        flush(start)
        for a in range(start, end, 128):
            n = min(128, end - a)
            out += bytes([257 - n if n > 1 else 0, data[a]])
        literal = end
    flush(len(data))
    return bytes(out)


def unlzw(data: bytes, need: int) -> bytes:
    """Codes of 9 to 12 bits, high bit first; the width grows one code early. No more than one entry beyond `need`."""
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, bits, held, at, width, last = [], 0, 0, 0, 9, None
    while need > 0:
        while held < width:
            if at >= len(data):
                return b"".join(out)
            bits, held, at = (bits << 8 | data[at]) & 0xFFFFFF, held + 8, at + 1
        code = bits >> (held - width) & ((1 << width) - 1)
        held -= width
        if code == 257:
            return b"".join(out)
        if code == 256:
            del table[258:]
            width, last = 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            if code > len(table):
                raise TiffError("bad LZW code")
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(entry)
        need -= len(entry)
        last = entry
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    """The codes are found one by one, and their bits put together at once."""
    codes, widths = [256], []
    table: dict[int, int] = {}
    width, size, code = 9, 258, -1
    for b in data:
        if code < 0:
            code = b
            continue
        key = code << 8 | b
        longer = table.get(key)
        if longer is not None:
            code = longer
            continue
        codes.append(code)
        table[key] = size
        size += 1
        if size == 4094:
            codes.append(256)
            widths += [width] * (len(codes) - len(widths))
            table, width, size = {}, 9, 258
        elif size + 1 > 1 << width:
            widths += [width] * (len(codes) - len(widths))
            width += 1
        code = b
    if code >= 0:
        codes.append(code)
        size += 1
        if size + 1 > 1 << width and width < 12:
            widths += [width] * (len(codes) - len(widths))
            width += 1
    codes.append(257)
    widths += [width] * (len(codes) - len(widths))
    places = np.arange(11, -1, -1)
    bits = np.array(codes)[:, None] >> places & 1
    return np.packbits(bits[places[None] < np.array(widths)[:, None]].astype(np.uint8)).tobytes()


PACK = {"none": lambda d: d, "lzw": lzw, "deflate": lambda d: zlib.compress(d, 1), "packbits": packbits}


def inflate(data: bytes, need: int) -> bytes:
    """At most `need` bytes, so that a small file cannot fill the memory."""
    return zlib.decompressobj().decompress(data, need)


#: How to unpack each compression, and the most bytes that it makes of one.
UNPACK = {1: (lambda data, need: data[:need], 1), 5: (unlzw, 3840), 8: (inflate, 1032), 32946: (inflate, 1032), 32773: (unpackbits, 64)}


#: How often over directories may go through a file.
MAX_OVERLAP = 4


def directories(data: bytes) -> Iterator[dict[int, tuple]]:
    """The tags of each image directory, as they are linked. Directories whose entries and values together are many times the file (they overlap) are an error."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or len(data) < 8 or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise TiffError("not a TIFF file")
    at, seen, spent = struct.unpack(order + "I", data[4:8])[0], set(), 0
    while at:
        if at in seen or at + 2 > len(data):
            raise TiffError("bad directory")
        seen.add(at)
        n = struct.unpack_from(order + "H", data, at)[0]
        tags, spent = {}, spent + 12 * n
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            spent += count
            if spent > MAX_OVERLAP * len(data):
                raise TiffError("directories overlap")
            if kind in TYPES:
                size = struct.calcsize(TYPES[kind]) * count
                place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
                tags[tag] = struct.unpack_from(f"{order}{count}{TYPES[kind]}", data, place)
        yield tags
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def page_samples(data: bytes, tags: dict[int, tuple], most: int = MAX_PAGE_BYTES) -> np.ndarray:
    """Samples of a page as (height, width, samples), strips or tiles unpacked and predictors undone. Pages of more than `most` bytes, or of more than their data can hold, are errors before anything is allocated."""
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, samples, planar = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(PLANAR, 1)
    if set(tags.get(BITS, (1,))) != {8} or not width or not height:
        raise TiffError("8-bit samples only")
    if not samples or planar not in (1, 2):
        raise TiffError("no samples or an unknown arrangement")
    unpack, ratio = UNPACK.get(one(COMPRESSION, 1), (None, 0))
    if not unpack:
        raise TiffError("unknown compression")
    tiled = TILE_OFFSETS in tags
    w, h = (one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
    if not w or not h:
        raise TiffError("no size of strips or tiles")
    offsets, sizes = (tags[TILE_OFFSETS], tags[TILE_BYTES]) if tiled else (tags.get(STRIP_OFFSETS, ()), tags.get(STRIP_BYTES, ()))
    across, down, planes = -(-width // w), -(-height // h), samples if planar == 2 else 1
    if len(offsets) < across * down * planes or len(sizes) != len(offsets):
        raise TiffError("too few strips or tiles")
    if width * height * samples > min(most, ratio * sum(min(n, len(data)) for n in sizes)) or w * h * samples > most:
        raise TiffError("page too large")
    each = samples // planes
    out = np.zeros((height, width, samples), dtype=np.uint8)
    for k in range(across * down * planes):
        plane, cell = divmod(k, across * down)
        top, left = cell // across * h, cell % across * w
        rows = h if tiled else min(h, height - top)
        raw = np.frombuffer(unpack(data[offsets[k] : offsets[k] + sizes[k]], rows * w * each), dtype=np.uint8)
        if len(raw) < rows * w * each:
            raise TiffError("short strip or tile")
        block = raw[: rows * w * each].reshape(rows, w, each)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        elif one(PREDICTOR, 1) != 1:
            raise TiffError("unknown predictor")
        part = out[top : top + rows, left : left + w]
        part[:, :, plane * each : (plane + 1) * each] = block[: part.shape[0], : part.shape[1]]
    return out


def read_pages(data: bytes, most: int = MAX_PAGE_BYTES) -> Iterator[np.ndarray]:
    """Page by page. All pages together are no more than what the file's compressed bytes, each counted once, can hold: pages that share strips are an error beyond that."""
    used: set[tuple[int, int]] = set()
    room = 0
    for tags in directories(data):
        ratio = UNPACK.get(tags.get(COMPRESSION, (1,))[0], (None, 0))[1]
        for offsets, sizes in ((STRIP_OFFSETS, STRIP_BYTES), (TILE_OFFSETS, TILE_BYTES)):
            for place in zip(tags.get(offsets, ()), tags.get(sizes, ()), strict=False):
                if place not in used:
                    used.add(place)
                    room += ratio * min(place[1], len(data))
        page = page_samples(data, tags, min(most, room))
        room -= page.size
        yield page


def write_tiff(pages: list[np.ndarray], compression: str = "deflate", predictor: bool = False, tile: tuple[int, int] | None = None, strip_rows: int = STRIP_ROWS, order: str = "<", planar: bool = False) -> bytes:
    """A file of pages (height, width, samples) of 8 bits. tile: width and height of tiles, multiples of 16, or none for strips."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for page in pages:
        height, width, samples = page.shape
        planes = [page[:, :, k : k + 1] for k in range(samples)] if planar else [page]
        w, h = tile or (width, strip_rows)
        places, sizes = [], []
        for plane in planes:
            for top in range(0, height, h):
                for left in range(0, width, w):
                    block = plane[top : top + h, left : left + w]
                    if tile:
                        block = np.pad(block, ((0, h - block.shape[0]), (0, w - block.shape[1]), (0, 0)), mode="edge")
                    if predictor:
                        block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1])).astype(np.uint8)
                    packed = PACK[compression](block.tobytes())
                    places.append(len(out))
                    sizes.append(len(packed))
                    out += packed + b"\0" * (len(packed) & 1)
        tags = [(WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [8] * samples), (COMPRESSION, "H", [CODES[compression]]), (PHOTOMETRIC, "H", [2 if samples == 3 else 1]), (SAMPLES, "H", [samples]), (PLANAR, "H", [2 if planar else 1]), (PREDICTOR, "H", [2 if predictor else 1])]
        tags += [(TILE_WIDTH, "I", [w]), (TILE_HEIGHT, "I", [h]), (TILE_OFFSETS, "I", places), (TILE_BYTES, "I", sizes)] if tile else [(STRIP_OFFSETS, "I", places), (ROWS_PER_STRIP, "I", [strip_rows]), (STRIP_BYTES, "I", sizes)]
        entries = b""
        for tag, kind, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{kind}", *values)
            if len(raw) > 4:
                raw, place = struct.pack(order + "I", len(out)), raw
                out += place + b"\0" * (len(place) & 1)
            entries += struct.pack(order + "HHI", tag, 3 if kind == "H" else 4, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def bytes_to_pages(payload: bytes, width: int = PAGE_WIDTH, rows: int = PAGE_ROWS) -> list[np.ndarray]:
    """Pages of one sample a pixel that hold the payload, a multiple of the width, row by row."""
    image = np.frombuffer(payload, dtype=np.uint8).reshape(-1, width, 1)
    return [image[a : a + rows] for a in range(0, len(image), rows)]


def page_feature(pages: list[np.ndarray]) -> str:
    """Pages, rows, mean and greatest sample, and the share of equal neighbours in a row, as text."""
    n = sum(p.size for p in pages)
    total = sum(int(p.sum(dtype=np.int64)) for p in pages)
    equal = sum(int((p[:, 1:] == p[:, :-1]).sum()) for p in pages)
    return f"pages={len(pages)};rows={sum(len(p) for p in pages)};mean={total / n:.4f};max={max(int(p.max()) for p in pages)};runs={equal / n:.4f}"


def pages_or_error(data: bytes) -> Iterator[tuple]:
    """(page, width, height, samples, pixels, None) of each page; a bad file ends with its error."""
    n = 0
    try:
        for n, x in enumerate(read_pages(data), 1):
            yield n - 1, x.shape[1], x.shape[0], x.shape[2], x.tobytes(), None
        if not n:
            raise TiffError("no pages")
    except BROKEN as e:
        yield None, None, None, None, None, str(e) or "broken file"


def tiff_pages(files: DataFrame, id_col: str = "file_id", data_col: str = "data") -> DataFrame:
    """One row a page: id, page, width, height, samples, pixels (row by row, chunky), error. A bad file gives its error in one row."""
    rows = files.select(F.col(id_col).alias("file_id"), F.col(data_col).alias("data"))
    kind = rows.schema["file_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
        for batch in batches:
            for k in range(batch.num_rows):
                for found in pages_or_error(batch.column("data")[k].as_py() or b""):  # a batch a page: one is held at a time
                    yield pa.RecordBatch.from_arrays([batch.column("file_id").slice(k, 1), *[pa.array([c], type=t) for c, t in zip(found, types, strict=True)]], names=["file_id", "page", "width", "height", "samples", "pixels", "error"])

    return in_arrow(rows, read, f"file_id {kind}, page int, width int, height int, samples int, pixels binary, error string")


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the bytes filled with 255 to a positive multiple of the page width)."""
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // PAGE_WIDTH)) * PAGE_WIDTH, b"\xff")


def store_and_read(docs: DataFrame, forms: Sequence[tuple[str, bool, tuple[int, int] | None]] = FORMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a TIFF file, read back: sizes, checksums of what was read, and a feature of the pages. Its form follows from its checksum, so equal texts have equal files and all forms are met."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def one(text: str | None) -> tuple:
        n, payload = payload_of(text)
        media = write_tiff(bytes_to_pages(payload), *forms[zlib.crc32(payload) % len(forms)])
        pages = list(read_pages(media))
        back = b"".join(p.tobytes() for p in pages)
        return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), page_feature(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(batch.column("_text")[k].as_py()) for k in range(batch.num_rows)]
            columns = zip(*found, strict=True) if found else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]], names=["doc_id", *names])

    return in_arrow(rows, run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
