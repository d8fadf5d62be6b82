"""The three votes on a guide."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guideloom.functions import votes


def attach_fold(guides: DataFrame, fold_results: DataFrame) -> DataFrame:
    """Guides with fold_ok. fold_results: (guide20, rna, structure_line), one row a guide; missing or not eligible: false."""
    joined = guides.withColumn("guide20", F.substring("sequence", 1, 20)).join(fold_results, "guide20", "left")
    ok = votes.fold_eligible(F.col("sequence")) & votes.fold_echo_ok(F.col("sequence"), F.col("rna")) & votes.fold_verdict(F.col("structure_line"))
    return joined.select(*guides.columns, ok.alias("fold_ok"))


def svm_vote(guides: DataFrame, params: dict, out: str = "sgrnascorer") -> DataFrame:
    """Guides with the decision of a linear (weights) or RBF (support_vectors, dual_coef, gamma) model: decision >= 0."""
    if "weights" in params:
        return guides.withColumn(out, votes.linear_decision(votes.one_hot80(F.col("sequence")), params["weights"], params["intercept"]) >= 0)
    vectors, coef = np.array(params["support_vectors"], dtype=float), np.array(params["dual_coef"], dtype=float)
    gamma, intercept = float(params["gamma"]), float(params["intercept"])
    codes = {c: [int(b) for b in bits] for c, bits in votes.ONE_HOT.items()}

    @F.pandas_udf("boolean")
    def decide(seqs: pd.Series) -> pd.Series:
        known = [s is not None and len(s) >= 20 and all(c in codes for c in s[:20]) for s in seqs]  # others have no vote, as with weights
        x = np.array([[b for c in s[:20] for b in codes[c]] for s, k in zip(seqs, known, strict=True) if k], dtype=float).reshape(-1, 80)
        far = (x**2).sum(1)[:, None] - 2 * x @ vectors.T + (vectors**2).sum(1)
        votes_ = iter((np.exp(-gamma * far) @ coef + intercept >= 0).tolist())
        return pd.Series([next(votes_) if k else None for k in known], dtype=object)

    return guides.withColumn(out, decide("sequence"))


def score_with(guides: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A plug-in folder or model: batches of guides in, batches of results out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return guides.mapInPandas(run, schema)


def score_efficiency(targets: DataFrame, fold_results: DataFrame, svm_params: dict) -> DataFrame:
    """(job_id, target_id, chopchop, mm10db, sgrnascorer, consensus)."""
    rows = svm_vote(attach_fold(targets, fold_results), svm_params)
    rows = rows.withColumn("chopchop", votes.chopchop(F.col("sequence"))).withColumn("mm10db", votes.mm10db(F.col("sequence"), F.col("fold_ok")))
    return rows.select("job_id", "target_id", *votes.TOOLS, votes.consensus_string(*map(F.col, votes.TOOLS)).alias("consensus"))
