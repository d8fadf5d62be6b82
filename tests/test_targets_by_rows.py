"""Guides that are compared within the row of their job."""

import random

import pytest

from guideloom.operators import targets


@pytest.mark.parametrize("longest", [50, targets.LONGEST_ROW])
def test_rows_and_matches_give_the_same_guides(spark, monkeypatch, longest):
    monkeypatch.setattr(targets, "LONGEST_ROW", longest)
    r = random.Random(5)
    part = lambda n, letters="ACGT": "".join(r.choices(letters, k=n))
    twice = part(60, "CG")
    made = ["", None, "C" * 22, "CC" + "A" * 19 + "GG", "G" * 40, twice + part(9) + twice, part(300, "ACGTN"), part(200, "ACGTacgt"), "CC" + "N" * 21 + part(90, "CG")]
    rows = [(f"j{i}", s) for i, s in enumerate(made + [part(r.randrange(400), "ACGGCT") for _ in range(40)])]
    rows += [("again", twice), ("again", part(80, "CG")), ("again", twice), (None, part(70, "CG"))]
    jobs = spark.createDataFrame(rows, "job_id string, sequence string")
    wanted = targets.unique_targets(targets.scan_targets(jobs))
    got = targets.unique_targets_by_rows(jobs)
    assert got.columns == wanted.columns and [f.dataType for f in got.schema] == [f.dataType for f in wanted.schema]
    found = lambda df: sorted((tuple(x) for x in df.collect()), key=repr)
    assert found(got) == found(wanted) and len(found(got)) > 500
    assert found(targets.design_guides(jobs, 100, by_rows=True)) == found(targets.design_guides(jobs, 100))


def test_guides_are_counted_by_hash(spark):
    jobs = spark.createDataFrame([("a", "ACGG" * 30)], "job_id string, sequence string")
    assert "SortAggregate" not in targets.unique_targets(targets.scan_targets(jobs))._jdf.queryExecution().executedPlan().toString()
