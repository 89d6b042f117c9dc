"""Aggregate reports.

All of them aggregate with a map-side partial step, so a hot key (one date,
one customer, one product) is pre-combined in every task before the shuffle
and never lands whole in one task. They plan as hash aggregates, but for the
minimum over structs (top product), which plans as a sort aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import as_date, days_before, month_start, to_date_value
from ledgerline.functions.money import as_money, fraction, money_avg, money_sum, money_sum_if, whole
from ledgerline.operators.partials import (
    category_conditions, channel_conditions, finished, partial_columns, region_conditions, with_limbs,
)

# Fixed values that must equal the reference's: the report limits.
REPORT_DAYS = 30
TOP_CUSTOMERS_LIMIT = 100
REPEAT_CUSTOMER_MIN_ORDERS = 1


def _amount() -> Column:
    return F.col("total_amount")


def load_stats(df: DataFrame, date=None) -> DataFrame:
    """A1: rows, revenue, mean, distinct customers for one date; NULL -> 0."""
    if date is not None:
        df = df.filter(F.col("order_date") == as_date(date))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(money_sum(_amount()), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(money_avg(_amount()), F.lit(0.0)).alias("avg_order_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def region_columns() -> list[Column]:
    """A3: one conditional sum per named region."""
    return [money_sum_if(c, _amount()).alias(n) for n, c in region_conditions().items()]


def channel_columns() -> list[Column]:
    """A4: one conditional sum per channel."""
    return [money_sum_if(c, _amount()).alias(n) for n, c in channel_conditions().items()]


def category_columns() -> list[Column]:
    """A5: named categories plus everything NOT IN them (NULL is neither)."""
    return [money_sum_if(c, _amount()).alias(n) for n, c in category_conditions().items()]


def daily_summary(enriched: DataFrame, start=None, end=None) -> DataFrame:
    """One row per order_date over [start, end] (a single date when
    start == end; yesterday of the run date in the daily job)."""
    df = enriched
    if start is not None:
        df = df.filter(F.col("order_date") >= as_date(start))
    if end is not None:
        df = df.filter(F.col("order_date") <= as_date(end))
    return finished(with_limbs(df).groupBy(F.col("order_date").alias("summary_date")).agg(
        *partial_columns(), F.countDistinct("customer_id").alias("unique_customers")))


def breakdown(enriched: DataFrame, columns: list[Column]) -> DataFrame:
    """A3/A4/A5 on their own, per order_date."""
    return enriched.groupBy(F.col("order_date").alias("summary_date")).agg(*columns)


def current_month_sales(enriched: DataFrame, as_of) -> DataFrame:
    """Per day from the first of as_of's month to as_of, ordered by day."""
    df = enriched.filter((F.col("order_date") >= month_start(as_of))
                         & (F.col("order_date") <= as_date(as_of)))
    return (df.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum(_amount()).alias("revenue"),
        money_avg(_amount()).alias("avg_order_value"))
        .orderBy("order_date"))


def _last_days(enriched: DataFrame, as_of, days: int) -> DataFrame:
    return enriched.filter((F.col("order_date") >= days_before(as_of, days))
                           & (F.col("order_date") <= as_date(as_of)))


def top_customers(enriched: DataFrame, as_of, days: int = REPORT_DAYS,
                  limit: int | None = TOP_CUSTOMERS_LIMIT) -> DataFrame:
    """A8 + L2: repeat customers of the last ``days`` days by spend.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``limit`` and only those rows reach the final merge. customer_id
    breaks ties so the cut is deterministic.
    """
    agg = (_last_days(enriched, as_of, days).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(_amount()).alias("total_spent"),
        money_avg(_amount()).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"))
        .filter(F.col("order_count") > REPEAT_CUSTOMER_MIN_ORDERS))
    out = agg.orderBy(F.col("total_spent").desc_nulls_last(), F.col("customer_id").asc_nulls_last())
    return out.limit(limit) if limit else out


def product_performance(enriched: DataFrame, as_of, days: int = REPORT_DAYS) -> DataFrame:
    """A9 + L3: per product and category over the last ``days`` days."""
    return (_last_days(enriched, as_of, days).groupBy("product", "product_category").agg(
        F.count(F.lit(1)).alias("times_sold"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(_amount()).alias("total_revenue"),
        money_avg(F.col("price")).alias("avg_price"))
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product").asc_nulls_last(),
                 F.col("product_category").asc_nulls_last()))


def top_product(df: DataFrame) -> DataFrame:
    """The product with the largest summed quantity over the whole
    frame; ties go to the alphabetically first product (one row)."""
    per_product = df.groupBy("product").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("_q"))
    best = F.min(F.struct((-F.col("_q")).alias("nq"), F.col("product").alias("p")))
    return per_product.agg(best["p"].alias("top_product"))


def _report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Orders, revenue, mean, top product and distinct customers per
    ``keys`` in one pass: sums per (keys, product) and per (keys, customer)
    as grouping sets, then one aggregate to the keys. No join, so rows of a
    NULL key are a group like any other."""
    amount = _amount()
    sums = (df.groupingSets([[*keys, "product"], [*keys, "customer_id"]],
                            *keys, "product", "customer_id")
            .agg(F.grouping("customer_id").alias("_by_product"), F.count(F.lit(1)).alias("_n"),
                 F.count(amount).alias("_amounts"), F.sum(whole(amount)).alias("_whole"),
                 F.sum(fraction(amount)).alias("_fraction"),
                 F.coalesce(F.sum("quantity"), F.lit(0)).alias("_q")))
    by_product = F.col("_by_product") == 1
    customers = lambda c: F.sum(F.when(~by_product, F.col(c)))
    revenue = as_money(customers("_whole"), customers("_fraction"))
    best = F.min(F.when(by_product, F.struct((-F.col("_q")).alias("nq"), F.col("product").alias("p"))))
    return sums.groupBy(*keys).agg(
        F.coalesce(customers("_n"), F.lit(0)).alias("total_orders"), revenue.alias("total_revenue"),
        (revenue / customers("_amounts").cast("double")).alias("average_order_value"),
        best["p"].alias("top_product"),
        F.count(F.when(~by_product, F.col("customer_id"))).alias("unique_customers"))


REPORT_COLUMNS = ("date", "total_orders", "total_revenue", "average_order_value", "top_product",
                  "unique_customers")


def sales_report(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """A10: one report per date (``date`` as yyyy-MM-dd text, NULL for rows
    without a date): orders, revenue, mean, top product, distinct customers.
    Works on the CSV job's frame (after ``derive_sales`` and ``fill_nulls``).
    """
    # Group on the date value (a 4-byte key) and format only the output rows.
    keyed = df.withColumn("_day", F.to_date(F.col(date_col)))
    return _report(keyed, ["_day"]).withColumn(
        "date", F.date_format("_day", "yyyy-MM-dd")).select(*REPORT_COLUMNS)


def run_report(df: DataFrame, run_date) -> DataFrame:
    """A10 as the original job makes it: one report over the whole frame,
    stamped with the run date."""
    return _report(df, []).withColumn(
        "date", F.lit(to_date_value(run_date).isoformat())).select(*REPORT_COLUMNS)


def revenue_by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("order_date").agg(money_sum(_amount()).alias("revenue"))


def revenue_variance(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Day-over-day revenue change. Each day's revenue goes to its own
    day and, as previous revenue, to the next; one group-by on the day puts
    them together (no self-join, and no global window, which would put every
    day in one task). A missing previous day gives NULL. A NULL order_date
    is a day of its own without a previous one."""
    daily = revenue_by_day(df)
    none = F.lit(None).cast("double")
    sides = daily.select(F.inline(F.array(
        F.struct(F.col("order_date"), F.lit(True).alias("own"), F.col("revenue"),
                 none.alias("previous_revenue")),
        F.struct(F.date_add("order_date", 1).alias("order_date"), F.lit(False).alias("own"),
                 none.alias("revenue"), F.col("revenue").alias("previous_revenue")))))
    sides = sides.where(F.col("own") | F.col("order_date").isNotNull())
    out = (sides.groupBy("order_date").agg(
        F.max("own").alias("own"), F.max("revenue").alias("revenue"),
        F.max("previous_revenue").alias("previous_revenue"))
        .where("own").drop("own")
        .withColumn("variance", F.col("revenue") - F.col("previous_revenue")))
    if threshold is not None:
        out = out.withColumn("exceeds", F.abs(F.col("variance")) > F.lit(threshold))
    return out
