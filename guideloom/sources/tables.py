"""Job requests, scoring messages, inventories; keyed writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guideloom.sources.staging import reread

JOB_REQUEST = "sequence string, genome string"
TARGET_MESSAGE = "JobID string, TargetID bigint, Sequence string, Count bigint, Start bigint, End bigint, Strand string"


def parse_jobs(requests: DataFrame, body: str = "value") -> DataFrame:
    """(sequence, genome, reject_reason) of JSON requests; a body that is no object, or lacks a field, has its reason."""
    parsed = requests.withColumn("_job", F.from_json(body, JOB_REQUEST))
    bad = F.col("_job").isNull() | (F.col("_job.sequence").isNull() & F.col("_job.genome").isNull())
    reason = F.when(F.col(body).isNull() | (F.trim(body) == ""), "no body").when(bad, "bad json").when(F.col("_job.sequence").isNull(), "no sequence").when(F.col("_job.genome").isNull(), "no genome")
    return parsed.select(*requests.columns, "_job.sequence", "_job.genome", reason.alias("reject_reason"))


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return parse_jobs(spark.read.text(path))


def decode_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Targets inside messages (JSON within JSON); broken or incomplete messages are left out."""
    outer = F.from_json(body, "default string, genome string")
    rows = messages.select(outer.alias("o")).select(F.from_json("o.default", TARGET_MESSAGE).alias("t"), F.get_json_object(F.concat(F.lit('{"g":'), F.col("o.genome"), F.lit("}")), "$.g").alias("genome"))
    rows = rows.select(F.col("t.JobID").alias("job_id"), F.col("t.TargetID").alias("target_id"), F.col("t.Sequence").alias("sequence"), "genome")
    return rows.filter("job_id is not null and target_id is not null and sequence is not null")


def encode_messages(targets: DataFrame, genome: Column) -> DataFrame:
    """The inverse: one message a target."""
    inner = F.to_json(F.struct(F.col("job_id").alias("JobID"), F.col("target_id").alias("TargetID"), F.col("sequence").alias("Sequence"), F.col("cnt").alias("Count"), F.col("start").alias("Start"), F.col("end").alias("End"), F.col("strand").alias("Strand")))
    return targets.select(F.to_json(F.struct(inner.alias("default"), F.concat(F.lit('"'), genome, F.lit('"')).alias("genome"))).alias("body"))


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(key, size) of the files under a path; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("key"), F.col("length").alias("size"))


def write_targets(targets: DataFrame, path: str, buckets: int = 256) -> None:
    """Replace the targets of the jobs that are written, and of no others.

    Targets lie by bucket of their job. The buckets touched are merged in the scratch folder and then replaced, so only they are read and written; a job written again without any target keeps its old ones."""
    spark = targets.sparkSession
    rows = reread(targets.withColumn("job_bucket", F.pmod(F.xxhash64("job_id"), F.lit(buckets)).cast("int")), "targets-new")
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        written = rows.select("job_bucket", "job_id").distinct()
        touched = [r["job_bucket"] for r in rows.select("job_bucket").distinct().collect()]  # no more than there are buckets
        others = old.filter(F.col("job_bucket").isin(touched)).join(written, ["job_bucket", "job_id"], "left_anti")
        rows = reread(rows.unionByName(others.select(rows.columns)), "targets-merged")
    rows.repartition("job_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_bucket").parquet(path)
