import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.enrich import enrich
from ledgerline.operators.ranking import _carried, rank_in_ranges

SCHEMA = "customer_id long, order_date date, part int, key string"


def ranked(df):
    w = Window.partitionBy("customer_id").orderBy(F.col("order_date").asc_nulls_first())
    return df.withColumn("r", F.rank().over(w).cast("long"))


def rows(n=3000):
    """One customer has a third of the rows, one day of it a tenth."""
    rng, day = random.Random(4), dt.date(2024, 1, 1)
    out = []
    for _ in range(n):
        hot = rng.random()
        customer = 7 if hot < 0.4 else None if hot < 0.5 else rng.randrange(40)
        when = day if hot < 0.1 else None if rng.random() < 0.05 else day + dt.timedelta(rng.randrange(60))
        out.append((customer, when, rng.randrange(5), "x"))
    return out + [(7, day, 1, "x")] * 50


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_equals_rank(spark, partitions):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rank_in_ranges(df, "customer_id", "order_date", "r")
        assert got.columns == [*df.columns, "r"]
        assert got.exceptAll(ranked(df)).count() == 0 and got.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    assert rank_in_ranges(spark.createDataFrame([], SCHEMA), "customer_id", "order_date", "r").collect() == []


def test_totals_cross_several_partitions():
    line = lambda p, k, o, fr, fp, lk, lo, lr, lp: {
        "_part": p, "key": k, "order": o, "first_rows": fr, "first_peers": fp, "last_key": lk, "last_order": lo,
        "last_rows": lr, "last_peers": lp}
    got = _carried([line(0, 1, 1, 2, 2, 5, 3, 4, 1), line(2, 5, 3, 6, 6, 5, 3, 6, 6), line(3, 5, 3, 3, 2, 5, 4, 3, 1),
                    line(4, 5, 9, 1, 1, 8, 1, 1, 1), line(5, 9, 1, 1, 1, 9, 1, 1, 1)])
    assert got == [(0, 0, 0), (2, 4, 1), (3, 10, 7), (4, 13, 0), (5, 0, 0)]


def test_plan_has_one_scan_and_no_join_back(spark, tmp_path):
    from tests.conftest import raw_rows
    raw = raw_rows(spark, [(k, k % 3, "Widget A", 1, 2.0, 2.0, dt.date(2024, 1, 1 + k % 9), "North", "Online")
                           for k in range(60)])
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    got = enrich(raw, stamp=False, in_ranges=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "Window" not in plan
    assert got.exceptAll(enrich(raw, stamp=False)).count() == 0
