"""The driver contract: every query runs, and agrees with its SQL."""

import os

import pytest

import __spark_entry__
from quire.plans import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: round(x, 9) if isinstance(x, float) else x
    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    got = plain(df.columns, df.collect())
    if name in catalogue.ORACLES:
        found = duck.execute(catalogue.ORACLES[name])
        assert got == plain([c[0] for c in found.description], found.fetchall())
    else:
        assert got[1]


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
