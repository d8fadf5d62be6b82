"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing and packing, each stage written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from guideloom.llm import mixing, near_dedup, packing, quality, secrets
from guideloom.llm.shared import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fertility band of their language that are long enough and do not repeat themselves."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles and a Jaccard similarity of 0.8."""
    return near_dedup.one_of_each(docs, width=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of their secrets and n_chars set anew."""
    return secrets.redacted(docs, length_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, share=1.5, max_epochs=2.0, cycle=(5, 2, 1))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(packing.pieces(docs))


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("secrets", secret_scans), ("mixing", source_mix), ("packing", best_fit_packing)]
#: SQL has no tokenisers and no seeded draws as here; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
