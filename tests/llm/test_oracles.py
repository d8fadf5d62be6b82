"""The operators that SQL can express, beside their SQL on the smallest tables."""

import duckdb
import pytest

from guideloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = sorted([tuple(r[names.index(c)] for c in columns) for r in result.fetchall()], key=repr)
    assert sorted(names) == columns and ours == theirs and ours
