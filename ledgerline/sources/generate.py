"""Synthetic sales records.

Deterministic for a given seed: the values come from hashes of the row id,
not from ``rand()``, so a recomputed partition (lost executor) yields the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import as_date

# Fixed values that must equal the reference's generator: first order id,
# customer id range, product names, quantity range, price range, regions
# and channels.
FIRST_ORDER_ID = 1000
CUSTOMER_ID_RANGE = (100, 999)
PRODUCTS = ("Widget A", "Widget B", "Widget C", "Gadget X", "Gadget Y")
QUANTITY_RANGE = (1, 5)
PRICE_RANGE = (19.99, 99.99)
REGIONS = ("North", "South", "East", "West")
CHANNELS = ("Online", "Retail", "Mobile")


def _unit(key: Column, seed: int, stream: int) -> Column:
    """Uniform [0, 1) from a 64-bit hash of (key, seed, stream)."""
    h = F.xxhash64(key, F.lit(seed), F.lit(stream))
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def _pick(values, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (u * len(values)).cast("int") + 1)


def _randint(lo: int, hi: int, u: Column) -> Column:
    return (F.lit(lo) + (u * (hi - lo + 1)).cast("long")).cast("long")


def generate_sales_for(keys: DataFrame, key_col: str, date_col: Column, seed: int = 42) -> DataFrame:
    """One synthetic sale per row of ``keys``; ``key_col`` drives the hashes."""
    k = F.col(key_col)
    qty = _randint(*QUANTITY_RANGE, _unit(k, seed, 3))
    lo, hi = PRICE_RANGE
    price = F.round(F.lit(lo) + _unit(k, seed, 4) * (hi - lo), 2)
    return (keys.select(
        (F.lit(FIRST_ORDER_ID) + k).cast("long").alias("order_id"),
        _randint(*CUSTOMER_ID_RANGE, _unit(k, seed, 1)).alias("customer_id"),
        _pick(PRODUCTS, _unit(k, seed, 2)).alias("product"),
        qty.alias("quantity"),
        price.alias("price"),
        date_col.cast("date").alias("order_date"),
        _pick(REGIONS, _unit(k, seed, 5)).alias("region"),
        _pick(CHANNELS, _unit(k, seed, 6)).alias("channel"),
    ).withColumn("total_amount", F.round(F.col("quantity") * F.col("price"), 2))
     .select("order_id", "customer_id", "product", "quantity", "price", "total_amount",
             "order_date", "region", "channel"))


def generate_sales(spark: SparkSession, date, n: int, seed: int = 42) -> DataFrame:
    """``n`` records for one date; ``spark.range`` spreads them over tasks."""
    ids = spark.range(n).withColumnRenamed("id", "i")
    return generate_sales_for(ids, "i", as_date(date), seed)
