"""Scratch paths in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, under a temporary folder in local mode; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def reread(df: DataFrame, name: str) -> DataFrame:
    """df written to a scratch path and read back: its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, name: str) -> None:
    """Delete a folder of scratch paths: what was reread as `name/...`, when nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, name).rpartition('/')[0]}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks at least as the cluster has cores: for heavy work per row on a few unsplittable files. Larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
