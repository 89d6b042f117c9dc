"""The daily summary as mergeable partial sums.

Every figure of the summary but the distinct customers is a count or an
exact sum of two integer limbs, so a day's figures are the sums of the
partial figures of whatever its rows were divided into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import as_money, fraction, whole

# Fixed values that must equal the reference's: the named regions, channels
# and product categories of the daily summary.
SUMMARY_REGIONS = ("North", "South", "East", "West")
SUMMARY_CHANNELS = ("Online", "Retail", "Mobile")
SUMMARY_CATEGORIES = ("Widgets", "Gadgets")

COUNTS = ("total_orders", "amounts", "data_quality_issues_count")


def region_conditions() -> dict[str, Column]:
    return {f"{r.lower()}_region_revenue": F.col("region") == r for r in SUMMARY_REGIONS}


def channel_conditions() -> dict[str, Column]:
    return {f"{c.lower()}_revenue": F.col("channel") == c for c in SUMMARY_CHANNELS}


def category_conditions() -> dict[str, Column]:
    """Named categories, and everything NOT IN them (NULL is neither)."""
    category = F.col("product_category")
    return ({f"{c.lower()}_revenue": category == c for c in SUMMARY_CATEGORIES}
            | {"other_revenue": ~category.isin(*SUMMARY_CATEGORIES)})


def conditions() -> dict[str, Column]:
    return region_conditions() | channel_conditions() | category_conditions()


def with_limbs(df: DataFrame) -> DataFrame:
    """The amount's limbs, computed once per row for all sums."""
    return df.withColumn("_whole", whole("total_amount")).withColumn("_fraction", fraction("total_amount"))


def _limbs(name: str, cond: Column | None = None) -> list[Column]:
    out = []
    for limb in ("_whole", "_fraction"):
        value = F.col(limb)
        if cond is not None:
            value = F.when(cond, value).otherwise(F.lit(0).cast("bigint"))
        out.append(F.sum(value).alias(name + limb))
    return out


def partial_columns(conds: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates over rows with limbs."""
    conds = conditions() if conds is None else conds
    return [F.count(F.lit(1)).alias("total_orders"), F.count("_whole").alias("amounts"),
            F.sum(F.when(F.col("has_data_quality_issues"), 1).otherwise(0)).cast("bigint")
             .alias("data_quality_issues_count"),
            *_limbs("total_revenue"), *[c for n, cond in conds.items() for c in _limbs(n, cond)]]


def revenue_names() -> list[str]:
    """Names of the conditional sums, in the summary's order."""
    return [*[f"{r.lower()}_region_revenue" for r in SUMMARY_REGIONS],
            *[f"{c.lower()}_revenue" for c in (*SUMMARY_CHANNELS, *SUMMARY_CATEGORIES)], "other_revenue"]


def partial_names() -> list[str]:
    return [*COUNTS, *[n + limb for n in ("total_revenue", *revenue_names()) for limb in ("_whole", "_fraction")]]


def merged_columns() -> list[Column]:
    """Aggregates over partial rows that give partial rows."""
    return [F.sum(n).alias(n) for n in partial_names()]


def money(name: str) -> Column:
    return as_money(F.col(f"{name}_whole"), F.col(f"{name}_fraction")).alias(name)


def finished(partials: DataFrame) -> DataFrame:
    """Summary rows from partial rows with ``unique_customers``, one a date."""
    total = money("total_revenue")
    return partials.select(
        "summary_date", "total_orders", total,
        (total / F.col("amounts").cast("double")).alias("average_order_value"),
        "unique_customers", *[money(n) for n in revenue_names()], "data_quality_issues_count")
