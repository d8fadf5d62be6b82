"""What users see: guides with votes and score, recommended guides, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guideloom.functions import votes


def guide_results(targets: DataFrame, consensus: DataFrame, scores: DataFrame) -> DataFrame:
    """All targets with whatever has been scored yet."""
    key = ["job_id", "target_id"]
    rows = targets.join(consensus.select(*key, "consensus"), key, "left").join(scores.select(*key, "score"), key, "left")
    return rows.select(*targets.columns, "consensus", "score", votes.efficient(F.col("consensus")).alias("efficient"), votes.specific(F.col("score")).alias("specific"), votes.accepted_by(F.col("consensus")).alias("accepted_by"))


def job_results(results: DataFrame, job_id) -> DataFrame:
    """One job's guides in order."""
    return results.filter(F.col("job_id") == job_id).orderBy("target_id")


def recommended_guides(results: DataFrame, min_votes: int = 2, min_score: float = 75) -> DataFrame:
    return results.filter((votes.votes_of(F.col("consensus")) >= min_votes) & votes.specific(F.col("score"), min_score))


def job_progress(targets: DataFrame, consensus: DataFrame, scores: DataFrame) -> DataFrame:
    """(job_id, num_guides, num_scored_ontarget, num_scored_offtarget), derived and so never counted twice."""
    key = ["job_id", "target_id"]
    done = lambda df, c: df.filter(F.col(c).isNotNull()).select(*key, F.lit(1).alias(f"has_{c}")).distinct()
    rows = targets.select(*key).join(done(consensus, "consensus"), key, "left").join(done(scores, "score"), key, "left")
    return rows.groupBy("job_id").agg(F.count("*").alias("num_guides"), F.count("has_consensus").alias("num_scored_ontarget"), F.count("has_score").alias("num_scored_offtarget"))


def results_json(results: DataFrame) -> DataFrame:
    """(job_id, body): {"recordsTotal": n, "data": [...]} of each job, by target_id."""
    row = F.struct("target_id", "sequence", "start", "end", "strand", "consensus")
    data = F.sort_array(F.collect_list(row))
    return results.groupBy("job_id").agg(F.to_json(F.struct(F.count("*").alias("recordsTotal"), data.alias("data"))).alias("body"))
