"""Runs of the scorer that get a bounded number of jobs."""

import json

import pytest
from pyspark.sql import functions as F

from guideloom.streaming import streams


@pytest.mark.parametrize(("n", "most"), [(0, 3), (3, 3), (4, 3), (500, 70), (9, 1)])
def test_no_run_has_more_jobs(spark, n, most):
    jobs, seen = spark.createDataFrame([(f"j{i}", "A" * i) for i in range(n)], "job_id string, sequence string"), []

    def score(part):
        seen.append(part.count())
        return part.select("job_id", F.length("sequence").alias("bases"), F.lit(len(seen)).alias("run"))

    rows = streams.in_slices(score, most, "slices-test")(jobs).collect()
    assert sorted((r["job_id"], r["bases"]) for r in rows) == sorted((f"j{i}", i) for i in range(n))
    assert all(x <= most for x in seen) and len(seen) == max(1, -(-n // most)) and sum(seen) == n


def test_failing_jobs_are_set_apart_from_slices(spark, tmp_path):
    (tmp_path / "in").mkdir()
    jobs = [{"job_id": f"j{i}", "sequence": "ACGT" * (i + 1), "genome": "g"} for i in range(7)] + [{"sequence": "ACGT"}]
    (tmp_path / "in/x.json").write_text("\n".join(map(json.dumps, jobs)))
    score = lambda part: part.select("job_id", F.when(F.col("job_id") == "j3", F.raise_error(F.lit("no score"))).otherwise(F.length("sequence")).alias("bases"))
    paths = [str(tmp_path / d) for d in ("out", "bad", "state")]
    streams.start_scoring(streams.stream_jobs(spark, str(tmp_path / "in")), score, *paths, {"availableNow": True}, dead_letters=str(tmp_path / "dead"), max_jobs=2).awaitTermination()
    read = spark.read.option("recursiveFileLookup", "true")
    assert sorted(r["bases"] for r in read.parquet(paths[0]).collect()) == [4 * (i + 1) for i in range(7) if i != 3]
    assert [r["job_id"] for r in read.parquet(str(tmp_path / "dead")).collect()] == ["j3"]
    assert [r["reject_reason"] for r in read.parquet(paths[1]).collect()] == ["no job id"]
