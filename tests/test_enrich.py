import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.enrich import (
    clean_filter, derive_sales, enrich, fill_nulls, null_counts, order_sequence,
)
from ledgerline.functions import binary_category, order_category, product_category

D1, D2 = dt.date(2024, 1, 14), dt.date(2024, 1, 15)


def test_golden_bands(golden):
    out = derive_sales(golden).withColumn("order_category", order_category()) \
        .withColumn("wh_category", product_category()).orderBy("order_id").collect()
    assert [r.order_category for r in out] == [
        "Medium Value", "Low Value", "Medium Value", "Low Value", "Medium Value"]
    assert {r.wh_category for r in out} == {"Widgets"}
    assert {r.product_category for r in out} == {"Electronics"}
    assert [round(r.total_amount, 2) for r in out] == [59.98, 49.99, 89.97, 19.99, 99.98]


def test_bands_edges(edge_raw):
    rows = {r.order_id: r for r in edge_raw.select(
        "order_id", order_category().alias("oc"), product_category().alias("pc"),
        binary_category().alias("bc")).collect()}
    assert rows[1].oc == "Medium Value"         # >= 50
    assert rows[2].oc == "High Value"           # >= 100
    assert rows[7].oc == "Low Value"            # NULL amount
    assert rows[4].pc == "Other"                # LIKE is case-sensitive
    assert rows[5].pc == "Widgets"              # first match wins
    assert rows[6].pc == "Other"                # NULL product
    assert rows[6].bc == "Other"
    assert rows[5].bc == "Electronics"


def test_clean_filter_drops_nulls_and_non_positive(edge_raw):
    ids = {r.order_id for r in clean_filter(edge_raw).collect()}
    assert ids == {1, 2, 3, 8, 9, None}


def test_enrich_day_vs_range(edge_raw):
    day = enrich(edge_raw, D2, D2, stamp=False)
    assert {r.customer_order_sequence for r in day.collect()} == {1}
    rng = {r.order_id: r.customer_order_sequence
           for r in enrich(edge_raw, D1, D2, stamp=False).collect()}
    assert rng[3] == 1 and rng[1] == 2 and rng[2] == 2   # peers share rank 2


def test_enrich_columns_and_flag(edge_raw):
    clean = enrich(edge_raw, stamp=True)
    assert len(clean.columns) == 19
    assert clean.filter("has_data_quality_issues").count() == 0   # filter precedes flag
    live = enrich(edge_raw, keep_invalid=True, stamp=False)
    flagged = {r.order_id for r in live.filter("has_data_quality_issues").collect()}
    assert flagged == {4, 5, 6}                                   # NULL q/p -> FALSE
    row = live.filter("order_id = 1").first()
    assert (row.day_of_week, row.month, row.quarter) == (2, 1, 1)  # Monday
    assert row.estimated_profit == 50.0 * 0.3


def test_order_sequence_matches_rank_with_hot_key(spark):
    """Skew-safe rank equals RANK(): hot customer, null key, null dates, peers."""
    rows = [(i, 7 if i % 3 else None if i % 5 == 0 else i % 11,
             None if i % 17 == 0 else dt.date(2024, 1, 1 + (i * 7) % 20)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, customer_id long, order_date date")
    ours = {r.id: r.customer_order_sequence for r in order_sequence(df).collect()}
    w = Window.partitionBy("customer_id").orderBy("order_date")
    ref = {r.id: r.rk for r in df.select("id", F.rank().over(w).alias("rk")).collect()}
    assert ours == ref


def test_fill_nulls(edge_raw):
    filled = fill_nulls(edge_raw)
    row = filled.filter("order_id = 6").first()
    assert row.customer_id == 0 and row.product == "0"
    assert null_counts(filled).first().asDict()["order_date"] == 0
    assert filled.filter(F.col("order_id") == 0).count() == 1
