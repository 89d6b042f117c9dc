"""Property checks: skew-safe rank == RANK(); cent sums == decimal sums."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.money import money_avg, money_sum
from ledgerline.operators.enrich import order_sequence

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)),
              st.one_of(st.none(), st.integers(0, 9))),
    min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_strategy)
def test_order_sequence_is_rank(spark, rows):
    data = [(i, c, None if d is None else dt.date(2024, 1, 1) + dt.timedelta(days=d))
            for i, (c, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, customer_id long, order_date date")
    ours = {r.id: r.customer_order_sequence for r in order_sequence(df).collect()}
    w = Window.partitionBy("customer_id").orderBy("order_date")
    ref = {r.id: r.rk for r in df.select("id", F.rank().over(w).alias("rk")).collect()}
    assert ours == ref


amounts = st.lists(st.one_of(st.none(), st.integers(-10_000_000, 10_000_000)),
                   min_size=1, max_size=80)


@SETTINGS
@given(cents=amounts)
def test_cent_sums_equal_decimal_sums(spark, cents):
    data = [(i % 3, None if c is None else round(c / 100.0, 2)) for i, c in enumerate(cents)]
    df = spark.createDataFrame(data, "g int, x double")
    got = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(
        money_sum("x").alias("s"), money_avg("x").alias("a")).collect()}
    ref = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(
        F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("s"),
        (F.sum(F.col("x").cast("decimal(18,2)")).cast("double") / F.count("x")).alias("a")
    ).collect()}
    assert got == ref
