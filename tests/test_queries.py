import math

import duckdb
import pytest

from cueforge.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def cell(x):
    if x is None or x != x:
        return "None"
    return "%.6g" % x if isinstance(x, float) and not math.isnan(x) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DIR).toPandas()
    if name in registry.oracle_sql():
        assert rows(got) == rows(duck.sql(registry.oracle_sql()[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
