"""Blocked gzip (BGZF): files that tasks unpack in parallel, at any block of the file system.

A blocked file (.bgz) is a chain of gzip members of at most 64 kB whose headers tell their sizes. The text
source splits it at these headers, so members are found by tasks that each read a byte range."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import reread

# Fixed values of the format: a member's header before its size, the empty member at the end, the most bytes in a member.
HEADER = bytes.fromhex("1f8b08040000000000ff060042430200")
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
PAYLOAD = 65_280
#: Bytes of members in one written row, about.
ROW = 1 << 20


def read_members(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, at, body): the members of blocked gzip files without their fixed header, in order of at within a block.

    Files are read by byte ranges, so they must be named .bgz, or anything but .gz: such a name makes the text source unpack a file as one stream."""
    reader = spark.read.option("lineSep", HEADER.decode("latin-1")).option("encoding", "ISO-8859-1")
    rows = reader.text(paths)
    if any(name.endswith(".gz") for name in rows.inputFiles()):
        raise ValueError("name blocked gzip files .bgz; .gz is unpacked as one stream, see read_fasta_lines")
    meta = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "file"), ("file_block_start", "block"))]
    return rows.select(*meta, F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("body"))


def unpacked(body: bytes) -> bytes:
    """The bytes of a member given without its fixed header. Another size, checksum or length than it states is an error: nothing is lost in silence."""
    if len(HEADER) + len(body) != int.from_bytes(body[:2], "little") + 1:
        raise ValueError("not a chain of blocked gzip members: use read_fasta for plain gzip")
    data = zlib.decompress(body[2:-8], wbits=-15)
    if zlib.crc32(data) != int.from_bytes(body[-8:-4], "little") or len(data) != int.from_bytes(body[-4:], "little"):
        raise ValueError("a blocked gzip member is damaged")
    return data


def packed(data: bytes) -> bytes:
    """A member that holds data, at most PAYLOAD bytes."""
    coder = zlib.compressobj(wbits=-15)
    body = coder.compress(data) + coder.flush()
    return HEADER + (len(HEADER) + len(body) + 9).to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


def stretches(data: bytes) -> list[bytes]:
    """What stands before the first line end; then each header line, and the sequence lines between headers as one; then what stands behind the last line end. Only the first if there is no line end."""
    lead, *rest = data.split(b"\n")
    if not rest:
        return [lead]
    *lines, tail = rest
    out, run = [lead], []
    for line in lines:
        if line.startswith(b">"):
            out += [b"".join(run), line] if run else [line]
            run = []
        else:
            run.append(line)
    return [*out, *([b"".join(run)] if run else []), tail]


def read_stretches(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, at, head, value): header lines, and pieces of sequence of at most 64 kB, of blocked gzip FASTA files; at orders the rows of a block.

    Only lines cut by the end of a member are looked at across members: their first letter tells whether they are headers, which are put together again; cut sequences stay cut. What is unpacked is staged: byte ranges and the order of rows hang on the cores that the cluster has when a file is read, and a second reading may find others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, block, at, body in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "at", "body")), strict=True):
                if not body:  # before a file's first header
                    continue
                data = unpacked(body)
                parts, ends = stretches(data), data.count(b"\n")
                rows += [(file, block, at, i, i in (0, len(parts) - 1), 0 if i else ends, part) for i, part in enumerate(parts)]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "at", "i", "edge", "ends", "value"])

    found = read_members(spark, paths).mapInArrow(cut, "file string, block long, at long, i int, edge boolean, ends int, value binary")
    found = reread(found.select("file", "block", F.struct("at", "i").alias("at"), "edge", "ends", F.col("value").cast("string").alias("value")), "blocked-lines")
    inner = found.filter(~F.col("edge")).select("file", "block", "at", F.col("value").startswith(">").alias("head"), "value")
    edges = found.filter("edge").drop("edge")
    # lines are numbered by the line ends before them, in the blocks before and in their own; those of a member stand behind its first stretch
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = edges.groupBy("file", "block").agg(F.sum("ends").alias("n")).select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines"))
    here = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("upto", F.sum("ends").over(here) - F.col("ends")).filter(F.length("value") > 0)
    edges = edges.join(blocks, ["file", "block"]).select("file", (F.col("lines") + F.col("upto")).alias("line"), "block", "at", "value")
    heads = edges.groupBy("file", "line").agg(F.min_by(F.substring("value", 1, 1), F.struct("block", "at")).alias("first")).filter("first = '>'").select("file", "line")
    whole = edges.join(heads, ["file", "line"]).groupBy("file", "line").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    whole = whole.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["at"].alias("at"), F.lit(True).alias("head"), F.array_join("parts.value", "").alias("value"))
    sequences = edges.join(heads, ["file", "line"], "left_anti").select("file", "block", "at", F.lit(False).alias("head"), "value")
    return inner.unionByName(sequences).unionByName(whole).withColumn("value", F.regexp_replace("value", "\r$", ""))


def write_blocked(lines: DataFrame, path: str) -> None:
    """The column value, a line a row, as blocked gzip: one file a partition. Rows in order within their partition; null is an empty line."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = bytearray(), bytearray()
        for batch in batches:
            for value in batch.column("value").to_pylist():
                held += (value or "").encode() + b"\n"
                while len(held) >= PAYLOAD:
                    out += packed(bytes(held[:PAYLOAD]))
                    del held[:PAYLOAD]
                if len(out) >= ROW:
                    yield pa.RecordBatch.from_arrays([pa.array([bytes(out)])], names=["value"])
                    out.clear()
        out += packed(bytes(held)) if held else b""
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([bytes(out)])], names=["value"])

    rows = lines.select(F.col("value").cast("string").alias("value")).mapInArrow(pack, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
