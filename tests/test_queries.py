"""Every registered query beside its SQL on the smallest tables; large ones are checked at sf0.01 by the driver."""

import math

import duckdb
import pytest

from guideloom.jobs import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    ours = sorted([tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()], key=repr)
    result = duck.execute(registry.ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = sorted([tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in result.fetchall()], key=repr)
    assert sorted(columns) == sorted(df.columns) and ours == theirs and ours


def test_entry_without_the_optional_part(spark):
    import __spark_entry__

    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(registry.ORACLES) <= set(__spark_entry__.oracle_sql())
