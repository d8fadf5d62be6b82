"""Planning of genome downloads, their completeness, and routing of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guideloom.functions.votes import is_public_accession

PART_BYTES = 50_000_000
INDEX_ENDINGS = (".issl", ".offtargets")


def plan_parts(files: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row a byte range: all columns of files (with file_size), part (from 1), start_byte, end_byte, parts_per_file, multipart."""
    size = F.col("file_size")
    parts = F.greatest(F.ceil(size / part_bytes), F.lit(1)).cast("int")
    rows = files.withColumn("parts_per_file", parts).withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts_per_file"))))
    start = (F.col("part") - 1).cast("long") * part_bytes
    return rows.withColumn("start_byte", start).withColumn("end_byte", F.least(start + part_bytes - 1, size - 1)).withColumn("multipart", size > part_bytes)


def latest_by_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row of each key with the greatest order_col. Aggregated before the shuffle, so repeated writes of one key are no hot spot."""
    others = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(order_col, *[c for c in others if c != order_col])).alias("last"))
    return last.select(*keys, *[F.col(f"last.{c}").alias(c) for c in others])


def file_status(plan: DataFrame, parts: DataFrame) -> DataFrame:
    """(filename, n_planned, n_present, complete). Repeated records of a part count once; parts that were never planned do not count."""
    planned = plan.select("filename", "part").distinct()
    present = parts.select("filename", "part", F.lit(1).alias("here")).distinct()
    rows = planned.join(present, ["filename", "part"], "left").groupBy("filename").agg(F.count("*").alias("n_planned"), F.count("here").alias("n_present"))
    return rows.withColumn("complete", F.col("n_planned") == F.col("n_present"))


def part_lists(parts: DataFrame) -> DataFrame:
    """(filename, parts): the parts with their tags in order. A file has few parts."""
    once = parts.groupBy("filename", "part").agg(F.max("etag").alias("etag"))
    return once.groupBy("filename").agg(F.sort_array(F.collect_list(F.struct("part", "etag"))).alias("parts"))


def genome_status(plan: DataFrame, objects: DataFrame) -> DataFrame:
    """(genome, num_files, files_present, complete). objects: (key, size), key = genome/fasta/file."""
    files = plan.select("genome", "file_name").distinct()
    there = objects.filter("size > 0").select(F.substring_index("key", "/", 1).alias("genome"), F.substring_index("key", "/", -1).alias("file_name"), F.lit(1).alias("here")).distinct()
    rows = files.join(there, ["genome", "file_name"], "left").groupBy("genome").agg(F.count("*").alias("num_files"), F.count("here").alias("files_present"))
    return rows.withColumn("complete", F.col("num_files") == F.col("files_present"))


def genome_of(key: Column) -> Column:
    return F.substring_index(key, "/", 1)


def genome_sizes(objects: DataFrame, limit_mb: float | None = 650) -> DataFrame:
    """(genome, fasta_bytes, index_mb, status): missing below one byte of FASTA, too large above the limit."""
    fasta = F.sum(F.when(F.contains("key", F.lit(".fna")), F.col("size")).otherwise(0))
    index = F.sum(F.when(F.col("key").endswith(".issl"), F.col("size")).otherwise(0)) / 1048576
    rows = objects.groupBy(genome_of(F.col("key")).alias("genome")).agg(fasta.alias("fasta_bytes"), index.alias("index_mb"))
    large = F.col("fasta_bytes") / 1048576 > limit_mb if limit_mb else F.lit(False)
    return rows.withColumn("status", F.when(F.col("fasta_bytes") < 1, "missing").when(large, "too large").otherwise("ok"))


def custom_genomes(objects: DataFrame) -> DataFrame:
    """Names of genomes that are no public accession."""
    names = objects.select(genome_of(F.col("key")).alias("genome")).distinct()
    return names.filter(~is_public_accession(F.col("genome")) & (F.col("genome") != "Test_Packages"))


def missing_indexes(genomes: DataFrame, objects: DataFrame) -> DataFrame:
    """(genome, key): index files that are expected but not there."""
    expected = genomes.select("genome").distinct().select("genome", F.explode(F.array(*[F.concat("genome", F.lit("/issl/"), "genome", F.lit(e)) for e in INDEX_ENDINGS])).alias("key"))
    return expected.join(objects.select("key"), "key", "left_anti").select("genome", "key")


def route_jobs(jobs: DataFrame, objects: DataFrame) -> DataFrame:
    """Jobs with route: download without FASTA, scan with FASTA and both index files, else index."""
    key, genome = F.col("key"), genome_of(F.col("key"))
    names = [F.max(F.when(key == F.concat(genome, F.lit("/issl/"), genome, F.lit(e)), 1).otherwise(0)) for e in INDEX_ENDINGS]
    state = objects.groupBy(genome.alias("genome")).agg(F.sum(F.when(F.contains(key, F.lit("/fasta/")), F.col("size")).otherwise(0)).alias("fasta"), (names[0] + names[1]).alias("indexes"))
    rows = jobs.join(state, "genome", "left")
    route = F.when(F.coalesce("fasta", F.lit(0)) <= 0, "download").when(F.col("indexes") == len(INDEX_ENDINGS), "scan").otherwise("index")
    return rows.select(*jobs.columns, route.alias("route"))
