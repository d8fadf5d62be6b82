"""Secret scans with structural confirmation.

Plain patterns give the base kinds (assign, access, hex). Further candidates are reported
only after a look at what they hold: base64 or hex runs are decoded and parsed as DER private
keys (RSA, DSA, elliptic curve, PKCS#8 plain or encrypted; lengths must fill each other
exactly) or OpenSSH private key files (all fields), so that public keys and certificates are
left alone, and dotted base64url triples must carry a signed-token header (JSON with "alg"). Runs that go on
in the next line are joined, line ends may be written as backslash and letter, and keys are
also tried at each place inside a run that looks like the start of one; such a key ends where
its own lengths say.

One pass, no shuffle, code point positions, end exclusive. Spans come by start, then kind
in the order of KINDS; one place may carry a base kind and a confirmed one.

Defined cases: null and empty texts have no spans; a very long run is decoded whole;
overlapping kinds are all reported; repeated rows give equal rows. A start of a key costs as
much as it has fields, of which only lengths and first bytes are decoded, whatever lengths it
claims, so the time of a text grows with its length.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_arrow, slices, texts_of

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "der", "openssh")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}+")
#: Runs that may be base64 or hex. The look-behind keeps the scan from trying each start in a word.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
#: A line end, as such or as a backslash and a letter.
BREAK = r"[ \t]*+(?:\r?\n|(?:\\+r)?\\+n)[ \t]*+"
#: A run with those that follow it line by line.
WRAPPED = re.compile(rf"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{{40,}}+(?:={{0,2}}{BREAK}[A-Za-z0-9+/_-]++)*+={{0,2}}")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\+[nrt/]){16,}+)-----END [A-Z0-9 ]*PRIVATE KEY-----")
#: Starts of keys: DER sequences and OpenSSH files in base64, DER sequences in hex.
START = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjEA|30(?:8[1-4]|[2-7][0-9A-Fa-f])")
#: The first part starts with an opening brace and a quote or white space, encoded. The look-ahead consumes nothing, so that a word before a header hides none.
JWT = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))(?=(e[wy][A-Za-z0-9_-]{6,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+))")
#: The start of OpenSSH files, object identifiers of password-based encryption (PKCS#5, PKCS#12), and those of keys whose PKCS#8 content is a key of the older form (RSA, elliptic curve).
SSH_MAGIC = b"openssh-key-v1\0"
PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
WRAPPED_KEYS = (bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"))
MIN_ASSIGN, MIN_ACCESS, MIN_KEY_BYTES = 8, 16, 24
#: Most fields of one level of a key, and most bytes of a name or an object identifier.
MAX_FIELDS, MAX_NAME = 16, 64


class Run:
    """A run without line ends or padding, and where its letters change."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def _changes(self) -> list[list[int]]:
        return [[m.start() for m in re.finditer(c, self.text)] for c in ("[-_]", "[+/]", "[^0-9A-Fa-f]")]

    def _next(self, kind: int, at: int) -> int:
        found = self._changes[kind]
        k = bisect_left(found, at)
        return found[k] if k < len(found) else len(self.text)

    def end(self, at: int, hexed: bool) -> int:
        """Where what starts at a place stops to be of one alphabet: hex digits, or standard or URL-safe base64."""
        return self._next(2, at) if hexed else max(self._next(0, at), self._next(1, at))


class Coded:
    """The bytes of a part of a run from `at` to before `stop`, decoded where they are looked at. Slices are parts of the same run."""

    def __init__(self, text: str, at: int, stop: int, hexed: bool = False, skip: int = 0, size: int | None = None):
        self.text, self.at, self.stop, self.hexed, self.skip = text, at, stop, hexed, skip
        self.size = ((stop - at) // 2 if hexed else (stop - at) * 3 // 4) if size is None else size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, k: int | slice) -> int | Coded:
        if isinstance(k, slice):
            a, b, _ = k.indices(self.size)
            return Coded(self.text, self.at, self.stop, self.hexed, self.skip + a, max(b - a, 0))
        return bytes(self[k : k + 1])[0]

    def __bytes__(self) -> bytes:
        first, last = self.skip, self.skip + self.size
        if self.hexed:
            return bytes.fromhex(self.text[self.at + 2 * first : self.at + 2 * last])
        part = self.text[self.at + first // 3 * 4 : min(self.at - (-last // 3) * 4, self.stop)]
        return (unbase64(part[: len(part) - (len(part) % 4 == 1)]) or b"")[first % 3 : first % 3 + self.size]


def name_of(data: bytes | Coded) -> bytes:
    """The bytes of a name; nothing if it is too long for one."""
    return bytes(data) if len(data) <= MAX_NAME else b""


def unbase64(run: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    body = run.rstrip("=")
    if len(body) % 4 == 1 or ("-" in body or "_" in body) and ("+" in body or "/" in body):
        return None
    try:
        return base64.b64decode(body.translate({45: "+", 95: "/"}) + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_item(data: bytes | Coded, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the content of the item at a place, if its length stays within end."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > end or data[start] == 0:
            return None
        size, start = int.from_bytes(bytes(data[start : start + n])), start + n
        if size < 0x80:
            return None
    return (tag, start, start + size) if start + size <= end else None


def der_fields(data: bytes | Coded, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill a content exactly; None if they do not, or are more than a key has."""
    found = []
    while at < end:
        item = der_item(data, at, end)
        if not item or len(found) == MAX_FIELDS:
            return None
        found.append(item)
        at = item[2]
    return found


def is_der_key(data: bytes | Coded, depth: int = 0) -> bool:
    """A private key whose sequence fills the data: RSA (PKCS#1), DSA, elliptic curve (SEC1), PKCS#8, or PKCS#8 encrypted. Public keys and certificates are none."""
    top = der_item(data, 0, len(data))
    fields = der_fields(data, top[1], top[2]) if top and top[0] == 0x30 and top[2] == len(data) else None
    if not fields or len(fields) < 2:
        return False
    tags, sizes = [f[0] for f in fields], [f[2] - f[1] for f in fields]

    def algorithm(item: tuple[int, int, int]) -> bytes | None:
        """The object identifier of an algorithm: a sequence of it and its parameters."""
        inner = der_fields(data, item[1], item[2])
        return name_of(data[inner[0][1] : inner[0][2]]) if inner and inner[0][0] == 0x06 and len(inner) <= 2 else None

    if tags[0] == 0x30:
        return tags == [0x30, 0x04] and sizes[1] >= MIN_KEY_BYTES and (algorithm(fields[0]) or b"").startswith(PASSWORD_SCHEMES)
    if tags[0] != 0x02 or sizes[0] != 1 or data[fields[0][1]] > 1:
        return False
    if set(tags) == {0x02}:  # numbers of an RSA or DSA key
        return len(tags) in (9, 6) and min(sizes[1], sizes[-1] if len(tags) == 6 else sizes[3]) >= MIN_KEY_BYTES // 2 and sizes[1] >= 2 * MIN_KEY_BYTES
    rest = [t for t in tags[2:] if t not in (0xA0, 0xA1, 0x81)]
    if tags[1] == 0x04:
        return sizes[1] >= MIN_KEY_BYTES and not rest and data[fields[0][1]] == 1
    if tags[1:3] == [0x30, 0x04] and len(rest) == 1:
        kind = algorithm(fields[1])
        inner = der_item(data, fields[2][1], fields[2][2])
        return bool(kind) and sizes[2] >= MIN_KEY_BYTES and inner is not None and inner[0] in (0x02, 0x04, 0x30) and inner[2] == fields[2][2] and (inner[0] != 0x30 or kind not in WRAPPED_KEYS or depth < 2 and is_der_key(data[fields[2][1] : fields[2][2]], depth + 1))
    return False


def ssh_string(data: bytes | Coded, at: int) -> tuple[bytes | Coded, int] | None:
    """(a length-prefixed field, the place behind it)."""
    end = at + 4 + int.from_bytes(bytes(data[at : at + 4])) if at + 4 <= len(data) else len(data) + 1
    return (data[at + 4 : end], end) if end <= len(data) else None


def is_public_blob(blob: bytes | Coded) -> bool:
    """Fields that fill a public key, the algorithm's name first."""
    at, fields = 0, []
    while at < len(blob):
        found = ssh_string(blob, at)
        if not found or len(fields) == MAX_FIELDS:
            return False
        fields.append(found[0])
        at = found[1]
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", name_of(fields[0])) is not None


def ssh_size(data: bytes | Coded) -> int | None:
    """The length of the OpenSSH private key file at the start of the data, all of whose fields are read; None if it is none."""
    if bytes(data[: len(SSH_MAGIC)]) != SSH_MAGIC:
        return None
    at, names = len(SSH_MAGIC), []
    for _ in range(3):  # cipher, derivation and its options
        found = ssh_string(data, at)
        if not found:
            return None
        names.append(name_of(found[0]))
        at = found[1]
    count, at = int.from_bytes(bytes(data[at : at + 4])), at + 4
    if not all(re.fullmatch(rb"[a-z0-9@.-]+", n) for n in names[:2]) or not 1 <= count <= 64:
        return None
    for _ in range(count):
        found = ssh_string(data, at)
        if not found or not is_public_blob(found[0]):
            return None
        at = found[1]
    found = ssh_string(data, at)
    if not found or len(found[0]) < MIN_KEY_BYTES or len(found[0]) % 8:
        return None
    if names[0] == b"none" and bytes(found[0][:4]) != bytes(found[0][4:8]):  # the check numbers of a key that is not encrypted
        return None
    return found[1]


def is_openssh(data: bytes) -> bool:
    """A private key file whose fields fill the data. Public keys are none."""
    return ssh_size(data) == len(data)


def is_signed_header(part: str) -> bool:
    raw = unbase64(part)
    if not raw or raw[:1] != b"{":
        return False
    try:
        header = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def confirmed(run: str) -> str | None:
    """The kind that a base64 or hex run turns out to hold."""
    for data in (bytes.fromhex(run) if len(run) % 2 == 0 and re.fullmatch(r"[0-9A-Fa-f]+", run) else None, unbase64(run)):
        if data:
            if is_der_key(data):
                return "der"
            if is_openssh(data):
                return "openssh"
    return None


def head_of(part: str, hexed: bool) -> bytes:
    """The first 15 bytes of a part of a run; keys are longer."""
    if hexed:
        return bytes.fromhex(re.match("(?:[0-9A-Fa-f]{2})*", part)[0])
    return unbase64(part[:20]) or b""


def may_begin(head: bytes) -> bool:
    """Whether a private key may start with these bytes: a sequence of a version (0 or 1) or an algorithm, and something that may follow."""
    if len(head) < 12 or head[0] != 0x30:
        return False
    k = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    return k < 7 and (head[k] == 0x30 or head[k : k + 2] == b"\x02\x01" and head[k + 2] < 2 and head[k + 3] in (0x02, 0x04, 0x30))


def key_inside(run: Run, at: int) -> tuple[int, str] | None:
    """(end, kind) of the key that starts at a place of a run."""
    text, hexed = run.text, run.text[at] == "3"
    if text[at] == "b":
        size = ssh_size(Coded(text, at, run.end(at, False)))
        return (at + -(-size * 4 // 3), "openssh") if size else None
    if not may_begin(head_of(text[at : at + 32], hexed)):
        return None
    data = Coded(text, at, run.end(at, hexed), hexed)
    top = der_item(data, 0, len(data))
    if not top or not is_der_key(data[: top[2]]):
        return None
    return at + (2 * top[2] if hexed else -(-top[2] * 4 // 3)), "der"


def keys_in_runs(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Keys that start inside a run or go on over line ends, but for those within found spans."""
    out, known, k = [], sorted(found), 0
    begun = {a for a, _, _ in found}
    for m in WRAPPED.finditer(text):
        bodies = [(p.start(), p[0]) for p in re.finditer(rf"{BREAK}|=+|[A-Za-z0-9+/_-]++", m[0]) if p[0][0] not in "= \t\r\n\\"]
        run, starts, firsts, n = "".join(t for _, t in bodies), [a for a, _ in bodies], [], 0
        for _, t in bodies:
            firsts.append(n)
            n += len(t)

        def place(i: int) -> int:
            b = bisect_right(firsts, i) - 1
            return m.start() + starts[b] + i - firsts[b]

        upto, at, whole = 0, 0, Run(run)
        while s := START.search(run, at):
            at = s.start() + 1
            start = place(s.start())
            while k < len(known) and known[k][0] <= start:
                upto = max(upto, known[k][1])
                k += 1
            if start < upto and start not in begun:
                continue
            key = key_inside(whole, s.start())
            if key:
                end = place(key[0] - 1) + 1
                out.append((start, end + len(re.match("={0,2}", text[end : end + 2])[0]), key[1]))
                at = key[0]
    return out


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    keys = [(m.start(), m.end(), kind) for m in RUN.finditer(text) if (kind := confirmed(m[0]))]
    if "PRIVATE KEY-----" in text:
        for m in ARMOUR.finditer(text):
            data = unbase64(re.sub(r"\\+[nrt]|\\+(?=/)|\s", "", m[2]))
            if data and (is_der_key(data) or is_openssh(data)):
                keys.append((m.start(), m.end(), "openssh" if is_openssh(data) else "der"))
    more = keys_in_runs(text, keys)
    ends = {(a, kind): b for a, b, kind in more}
    found += more + [s for s in keys if s[1] >= ends.get((s[0], s[2]), 0)]  # a key's first line alone gives way
    if "ey" in text or "ew" in text:
        upto = 0
        for m in JWT.finditer(text):
            if m.start() >= upto and is_signed_header(m[1]):
                upto = m.end(3)
                found.append((m.start(), upto, "jwt"))
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id and spans, an array of (kind, start, end)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in find_spans(t)] for t in texts_of(batch, "_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, type=pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"])

    return in_arrow(rows, find, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each covered stretch replaced by one mark."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents with their secrets replaced; length_col, if given, is set to the new length. Columns and order as in docs."""
    schema = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [None if t is None else redact(t, find_spans(t)) for t in batch.column(text_col).to_pylist()]
            new = {text_col: pa.array(texts, type=pa.string())}
            if length_col:
                new[length_col] = pa.array([None if t is None else len(t) for t in texts], type=batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays([new.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)], names=batch.schema.names)

    return in_arrow(docs, clean, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans, and all spans as text."""
    spans = scan(docs)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select("doc_id", *map(count, BASE_KINDS), F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", text), ",").alias("spans"))
