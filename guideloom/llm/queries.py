"""Registered queries: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, interpolation, language, licenses, mixing, near_dedup, oracles, packing, quality, secrets, spelling, suffix_dedup, tiff, urls


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of their words, at most two epochs a source, weights 5, 2, 1 along the sources."""
    mixed = mixing.mix(_documents(spark, sf_dir), share=1.5, max_epochs=2.0, cycle=(5, 2, 1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, fertility and verdict of every document."""
    return quality.quality(_documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept", *[F.round(c, 6).alias(c) for c in quality.MEASURES])


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: three-word shingles, Jaccard of 85 % or more."""
    return near_dedup.near_duplicates(_documents(spark, sf_dir), width=3, percent=85)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that start earlier."""
    return suffix_dedup.without_repeats(_documents(spark, sf_dir), span=100)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(packing.pieces(_documents(spark, sf_dir)))


#: Phrase and label.
LICENSE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.license_scan(_documents(spark, sf_dir), LICENSE_PHRASES)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts, their digest, and all spans."""
    return secrets.digest(_documents(spark, sf_dir))


#: Fixed values: (verdict, host, start of the path), and the names of hosts whose URLs make the list.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
LISTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills)\."


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL. The list: canonical URLs of the pages on hosts with a blocked name."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = pages.filter(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select(urls.canonical(F.col("url")).alias("canon"))
    return urls.url_filter(pages, listed, URL_RULES)


def op9_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as TIFF pages and read back."""
    return tiff.store_and_read(_documents(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of the documents, by checksum of the id, is never learned from."""
    docs = _documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    dictionaries = language.learn(docs, ~F.coalesce(held_out, F.lit(False)))
    judged = language.identify(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), dictionaries, keep=("held_out",))
    return judged.select("doc_id", "held_out", "lang_pred", F.round("score", 9).alias("score"), "rejected")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's words; a tenth of those with 20 words is drawn."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = importance.resample(_documents(spark, sf_dir), target, n=1, buckets=10_000, min_words=20, percent=10, seed="2024")
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents, with one planted error in 97 runs."""
    return spelling.grouped(spelling.word_counts(_documents(spark, sf_dir), drop_every=97, min_letters=5, min_count=3), ratio=2)


def op13_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; a seventh of the documents, by checksum of the id, is never learned from, and an eighth of the others sets the weights."""
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return interpolation.scores(_documents(spark, sf_dir), may_learn=draw % 7 != 2, delete=F.floor(draw / 7) % 8 == 0)


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op13_interpolation: counts and base score of every document."""
    return op13_interpolation(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 4))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op2_quality: the counts and base rules of every document."""
    return quality.quality(_documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed")


def secret_base_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op7_secrets: the base kinds of every document and their places."""
    return secrets.digest(_documents(spark, sf_dir)).drop("spans")


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op9_tiff: the bytes read back from every document's file."""
    return tiff.store_and_read(_documents(spark, sf_dir)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


QUERIES = {f.__name__: f for f in (quality_counts, secret_base_kinds, media_payloads, lm_base_scores, op1_mixing, op2_quality, op3_near_dedup, op4_suffix_dedup, op5_packing, op6_licenses, op7_secrets, op8_urls, op9_tiff, op10_language, op11_importance, op12_spelling, op13_interpolation)}
ORACLES = oracles.ORACLES
