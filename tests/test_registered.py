"""The registered queries against their SQL on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry_points
from workload.oracles import ORACLES
from workload.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test data is absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(str, frame.where(frame.notna(), None).values.tolist()))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert all(r["rating"] >= 8 for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert plain(got) == plain(expected)
