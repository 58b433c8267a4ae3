"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import bench
from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normalised
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = normalised(QUERIES[name](spark, SF_DIR).toPandas())
    expected = normalised(sql.execute(ORACLES[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert len(got) > 0 or name == "stream_start_latest"
    assert got.equals(expected)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_bench_runs_its_large_queries(spark):
    assert bench.large_codec(spark, SF_DIR, 1_000).agg({"n": "sum"}).first()[0] == 1_000
    assert tuple(bench.large_audit(spark, SF_DIR, 1_000).first()) == (1_000, 1_000, 0, 0, 0)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["day", "n"] and df.count() > 0
