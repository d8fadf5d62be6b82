"""FASTA in, site lists out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guideloom.functions.windows import in_arrow
from guideloom.operators.sites import places_of

from .blocked import read_stretches

#: Files whose names may be sent to all tasks.
MAX_BROADCAST_FILES = 50_000


def read_fasta(spark: SparkSession, paths: str | list[str], genome: str | None = None, partitions: int | None = None) -> DataFrame:
    """(genome, contig, seq) of all records of (gzipped) FASTA files; a file without a header is one contig named by its path.

    One record is one row, so a record must fit a task; `partitions` spreads records of unsplittable files. For longer ones see read_fasta_lines."""
    rows = spark.read.option("lineSep", "\n>").text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = rows.repartition(partitions) if partitions else rows
    value = F.regexp_replace("value", "\r", "")
    # only the first record of a file keeps its own mark, and a file without headers has just one record
    headed = F.col("start").isNotNull() & (value.startswith(">") | ~F.col("plain"))
    plain = rows.groupBy("path").agg((F.max(F.col("value").startswith(">").cast("int")) == 0).alias("plain"))
    rows = rows.join(F.broadcast(plain) if len(rows.inputFiles()) <= MAX_BROADCAST_FILES else plain, "path")
    body = F.regexp_replace(value, "^>", "")
    contig = F.when(headed, F.trim(F.substring_index(body, "\n", 1))).otherwise(F.col("path"))
    seq = F.when(headed, F.when(F.contains(body, F.lit("\n")), F.substring(body, F.locate("\n", body) + 1, F.length(body))).otherwise("")).otherwise(value)
    return rows.select(F.lit(genome).cast("string").alias("genome"), contig.alias("contig"), F.upper(F.regexp_replace(seq, r"\s", "")).alias("seq"))


def read_fasta_lines(spark: SparkSession, paths: str | list[str], genome: str | None = None, blocked: bool = False, headers: bool = False) -> DataFrame:
    """(genome, file, record, contig, offset, seq): the lines of FASTA files, each with its place in its contig; record counts headers in a file.

    No row holds more than a line. Lines are numbered within their file block; sums of the blocks before give the rest, so a contig may span any number of blocks. Lines without a header before them belong to a contig named by the path.

    headers: a row without bases, at offset 0, for each header as well, so that contigs without bases are seen.

    blocked: files of blocked gzip, named .bgz; tasks unpack them in parallel, and a row holds a piece of at most 64 kB of the bases between two headers. Plain gzip is unpacked by one task a file."""
    if blocked:
        return placed_lines(read_stretches(spark, paths), genome, headers)
    meta = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "file"), ("file_block_start", "block"))]
    rows = spark.read.text(paths).select(*meta, F.monotonically_increasing_id().alias("at"), F.col("value").startswith(">").alias("head"), "value")
    return placed_lines(rows, genome, headers)


def placed_lines(rows: DataFrame, genome: str | None, headers: bool = False) -> DataFrame:
    """What read_fasta_lines returns, from (file, block, at, head, value): header lines and pieces of sequence in order of at within each block of a file."""
    head = F.col("head")
    name = F.when(head, F.trim(F.substring("value", 2, 1 << 30)))
    rows = rows.select("file", "block", "at", name.alias("name"), F.when(~head, F.upper(F.regexp_replace("value", r"\s", ""))).alias("seq"))
    here, n = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0), F.coalesce(F.length("seq"), F.lit(0)).cast("long")
    rows = rows.withColumn("upto", F.sum(n).over(here)).withColumn("heads", F.count("name").over(here))
    rows = rows.withColumn("own_start", F.max(F.when(F.col("name").isNotNull(), F.col("upto"))).over(here)).withColumn("own_name", F.last("name", ignorenulls=True).over(here))
    blocks = rows.groupBy("file", "block").agg(F.max("upto").alias("bases"), F.max("heads").alias("n_heads"), F.max("own_start").alias("start"), F.max_by("own_name", "at").alias("last_name"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("bases_before", F.coalesce(F.sum("bases").over(before), F.lit(0))).withColumn("heads_before", F.coalesce(F.sum("n_heads").over(before), F.lit(0)))
    blocks = blocks.withColumn("start_before", F.coalesce(F.max(F.col("bases_before") + F.col("start")).over(before), F.lit(0))).withColumn("name_before", F.last("last_name", ignorenulls=True).over(before))
    kept = (F.length("seq") > 0) | F.col("name").isNotNull() if headers else F.length("seq") > 0
    placed = rows.filter(kept).withColumn("seq", F.coalesce("seq", F.lit(""))).join(blocks.select("file", "block", "bases_before", "heads_before", "start_before", "name_before"), ["file", "block"])
    start = F.coalesce(F.col("bases_before") + F.col("own_start"), F.col("start_before"))
    offset = F.col("bases_before") + F.col("upto") - F.length("seq") - start
    return placed.select(F.lit(genome).cast("string").alias("genome"), "file", (F.col("heads_before") + F.col("heads")).alias("record"), F.coalesce("own_name", "name_before", "file").alias("contig"), offset.alias("offset"), "seq")


def write_sites(sites: DataFrame, path: str) -> None:
    """A folder of each genome (genome=...) with one site a line, duplicates kept, in order within files and from file to file by name. One range shuffle, in which a genome of any size is dealt out by its sites."""
    ordered = sites.select("genome", "site").repartitionByRange("genome", "site").sortWithinPartitions("genome", "site")
    ordered.write.mode("overwrite").partitionBy("genome").text(path)


def write_site_lists(lists: DataFrame, path: str) -> None:
    """What write_sites writes, from packed_lists of sites: a packed row travels and is put in order as such, and its lines are written at once."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, letters in places_of(batch):
                text = np.pad(letters, ((0, 0), (0, 1)), constant_values=ord("\n")).tobytes()[:-1].decode()
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(k, 1) for c in key), pa.array([text])], names=[*key, "value"])

    key = ["genome", "bucket", "part"]
    ordered = in_arrow(lists.repartitionByRange(*key), lines, "genome string, bucket int, part int, value string").sortWithinPartitions(*key)
    ordered.select("genome", "value").write.mode("overwrite").partitionBy("genome").text(path)
