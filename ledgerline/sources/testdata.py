"""Adapter from the driver's TPC-H-style tables to the sales, user and
snapshot shapes the library works on. The joins belong to the adapter."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import to_date_value
from ledgerline.operators.joins import broadcast_if_small

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Region names per n_regionkey and channel names per o_orderkey % 3, the
# adapter's own mapping; key 4 falls to the unnamed bucket on purpose.
REGION_BY_KEY = ((0, "South"), (1, "West"), (2, "East"), (3, "North"))
REGION_OTHER = "Central"
CHANNEL_BY_MOD = ((0, "Online"), (1, "Retail"))
CHANNEL_OTHER = "Mobile"
NATION_MAX_ROWS = 1000


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's read-only table, read once per application: the file
    listing and footer schema inference are paid once, later queries reuse
    the same base DataFrame (nothing is cached in memory)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _region(col):
    expr = None
    for key, name in REGION_BY_KEY:
        expr = F.when(col == key, name) if expr is None else expr.when(col == key, name)
    return expr.otherwise(REGION_OTHER)


def _channel(col):
    m = F.pmod(col, F.lit(3))
    expr = None
    for key, name in CHANNEL_BY_MOD:
        expr = F.when(m == key, name) if expr is None else expr.when(m == key, name)
    return expr.otherwise(CHANNEL_OTHER)


def sales_orders(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """Order-level attributes: order_id, customer_id, order_date, region, channel.

    The date range is applied to the raw ``o_orderdate`` timestamp so the
    predicate reaches the parquet scan.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Literal typed like the column (timestamp or timestamp_ntz), so no cast
    # lands on the column side and the bound is pushed to the scan.
    ts_type = orders.schema["o_orderdate"].dataType.simpleString()

    def day_start(d):
        return F.lit(_dt.datetime.combine(d, _dt.time()).isoformat(sep=" ")).cast(ts_type)

    if start is not None:
        orders = orders.filter(F.col("o_orderdate") >= day_start(to_date_value(start)))
    if end is not None:
        orders = orders.filter(
            F.col("o_orderdate") < day_start(to_date_value(end) + _dt.timedelta(days=1)))
    nation = broadcast_if_small(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), NATION_MAX_ROWS,
        cache_key=f"{sf_dir}/nation")
    cust = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("order_id"),
                    F.when(F.col("o_custkey") != 0, F.col("o_custkey")).alias("customer_id"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    _region(F.col("n_regionkey")).alias("region"),
                    _channel(F.col("o_orderkey")).alias("channel")))


def sales_from_testdata(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """Raw sales (RAW_SALES schema), one row per line item.

    lineitem joins the (date-filtered) orders first, so the part join only
    sees rows in range; AQE turns either join into a broadcast when its
    runtime size allows and splits skewed partitions otherwise.
    """
    orders = sales_orders(spark, sf_dir, start, end)
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = (items.join(orders, F.col("l_orderkey") == F.col("order_id"))
              .join(part, F.col("l_partkey") == F.col("p_partkey")))
    quantity = (F.col("l_quantity").cast("bigint") - 1)
    price = F.round(F.col("p_retailprice") - F.lit(890.0), 2)
    product = F.replace(F.replace(F.col("p_name"), F.lit("widget"), F.lit("Widget")),
                        F.lit("gizmo"), F.lit("Gadget"))
    return (joined.select(
        F.col("order_id"), F.col("customer_id"), product.alias("product"),
        quantity.alias("quantity"), price.alias("price"),
        F.round(quantity * price, 2).alias("total_amount"),
        F.col("order_date"), F.col("region"), F.col("channel")))


def csv_sales_from_testdata(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """The CSV job's six input columns."""
    return sales_from_testdata(spark, sf_dir, start, end).select(
        "order_id", "customer_id", "product", "quantity", "price", "order_date")


def _name_parts():
    first = F.split(F.col("c_name"), "#").getItem(0)
    last = F.split(F.col("c_name"), "#").getItem(1)
    email = F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com")))
    return first, last, email


def user_docs_from_customer(spark: SparkSession, sf_dir: str, segment: str | None = None) -> DataFrame:
    """One nested user document (JSON text in ``value``) per customer,
    optionally only those of one market segment."""
    first, last, email = _name_parts()
    doc = F.struct(F.col("c_custkey").cast("string").alias("id"),
                   F.struct(first.alias("firstName"), last.alias("lastName"),
                            email.alias("email")).alias("personalInfo"))
    cust = table(spark, sf_dir, "customer")
    if segment is not None:
        cust = cust.filter(F.col("c_mktsegment") == segment)
    return cust.select(F.to_json(doc).alias("value"))


def user_docs_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with repeated ids: one document per order, for its customer."""
    first, last, email = _name_parts()
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    doc = F.struct(F.col("c_custkey").cast("string").alias("id"),
                   F.struct(first.alias("firstName"), last.alias("lastName"),
                            email.alias("email")).alias("personalInfo"))
    return (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.to_json(doc).alias("value")))


def snapshots_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents: one per event, keyed by user, stamped with ts.

    Columns: user_id, snapshot_ts, snapshot_id, doc (JSON text with a
    one-element ``results`` array). ``postcode`` is written as a JSON
    number to exercise the mixed-type field.
    """
    eid = F.col("event_id").cast("string")
    location = F.struct(
        F.struct(F.col("event_id").alias("number"), F.col("event_type").alias("name")).alias("street"),
        F.concat(F.lit("city-"), F.col("event_type")).alias("city"),
        F.concat(F.lit("state-"), F.pmod(F.col("user_id"), F.lit(7)).cast("string")).alias("state"),
        F.lit("NL").alias("country"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("postcode"),
        F.struct(F.format_string("%.2f", F.col("value")).alias("latitude"),
                 F.format_string("%.2f", -F.col("value")).alias("longitude")).alias("coordinates"),
        F.struct(F.lit("+1:00").alias("offset"), F.lit("Central Europe").alias("description")).alias("timezone"),
    )
    login = F.struct(
        F.md5(eid).alias("uuid"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"),
        F.substring(F.sha1(eid), 1, 10).alias("password"),
        F.substring(F.md5(F.concat(eid, F.lit("salt"))), 1, 8).alias("salt"),
        F.md5(F.concat(F.lit("pw"), eid)).alias("md5"),
        F.sha1(F.concat(F.lit("pw"), eid)).alias("sha1"),
        F.sha2(F.concat(F.lit("pw"), eid), 256).alias("sha256"),
    )
    result = F.struct(
        F.lit("female").alias("gender"),
        F.struct(F.lit("Ms").alias("title"), F.lit("Ada").alias("first"),
                 F.col("user_id").cast("string").alias("last")).alias("name"),
        location.alias("location"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        login.alias("login"),
    )
    doc = F.struct(F.array(result).alias("results"),
                   F.struct(F.lit("seed").alias("seed"), F.lit(1).cast("bigint").alias("results"),
                            F.lit(1).cast("bigint").alias("page"), F.lit("1.4").alias("version")).alias("info"))
    return table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").alias("snapshot_ts"), F.col("event_id").alias("snapshot_id"),
        F.to_json(doc).alias("doc"))
