"""The registered query set: one callable (spark, sf_dir) -> DataFrame per
operator of the inventory, over the driver's test tables.

Every query reads the given tables (through the adapter in
``sources.testdata``) and runs over all of their rows; date windows are the
feature of the report they belong to, never a way to cut the input.
Queries whose feature is a write (sinks, streaming, jobs) write under the
session's work folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.calendar import as_date, iso_date
from ledgerline.functions.money import money_avg, money_sum, money_sum_if
from ledgerline.operators.asof import as_of_join
from ledgerline.operators.enrich import (
    RAW_COLUMNS, clean_filter, derive_sales, enrich, fill_nulls,
)
from ledgerline.operators.quality import gates, quality_profile, quality_struct
from ledgerline.operators.reports import (
    breakdown, category_columns, channel_columns, current_month_sales, daily_summary,
    load_stats, product_performance, region_columns, revenue_variance, run_report, sales_report,
    top_customers, top_product,
)
from ledgerline.operators.users import (
    flatten_users, latest_snapshot, new_rows_by_key, records_to_json, split_snapshot,
    to_user_rows,
)
from ledgerline.plans import params as P
from ledgerline.session import free_shuffles, input_bytes, scratch_path
from ledgerline.sources import testdata as TD
from ledgerline.sources.files import read_csv, read_sales_csv, read_snapshots
from ledgerline.sources.generate import (
    CHANNELS, CUSTOMER_ID_RANGE, PRICE_RANGE, PRODUCTS, QUANTITY_RANGE, REGIONS, generate_sales_for,
)

ENRICHED_OUT = [*RAW_COLUMNS, "order_category", "product_category", "day_of_week", "month",
                "quarter", "customer_order_sequence", "revenue", "estimated_profit",
                "has_data_quality_issues"]


def _raw(spark, d, start=None, end=None) -> DataFrame:
    return TD.sales_from_testdata(spark, d, start, end)


def _enriched(spark, d, start=None, end=None, keep_invalid=False, rank=True) -> DataFrame:
    return enrich(_raw(spark, d, start, end), start, end, keep_invalid=keep_invalid,
                  stamp=False, with_sequence=rank)


def _report_input(spark, d, start=None, end=None) -> DataFrame:
    """Enriched rows for reports that never read the order sequence."""
    return _enriched(spark, d, start, end, rank=False)


def _csv_frame(spark, d) -> DataFrame:
    return derive_sales(TD.csv_sales_from_testdata(spark, d))


# ---- enrichment and projections -------------------------------------------

def q_enrich_range(spark, d):
    return _enriched(spark, d, P.WINDOW_START, P.AS_OF).select(*ENRICHED_OUT)


def q_enrich_day(spark, d):
    return _enriched(spark, d, P.AS_OF, P.AS_OF).select(*ENRICHED_OUT)


def q_customer_order_sequence(spark, d):
    return _enriched(spark, d).select("customer_id", "order_date", "order_id", "product",
                                      "quantity", "customer_order_sequence")


def q_scan_day(spark, d):
    return _raw(spark, d, P.AS_OF, P.AS_OF)


def q_scan_backfill(spark, d):
    return _raw(spark, d, *P.BACKFILL)


def q_derive_total(spark, d):
    return _csv_frame(spark, d).select("order_id", "customer_id", "product", "quantity", "price",
                                       "order_date", "total_amount")


def q_category_binary(spark, d):
    return _csv_frame(spark, d).select("order_id", "product", "product_category")


def _all_bands(spark, d):
    return _enriched(spark, d, keep_invalid=True, rank=False)


def q_order_category(spark, d):
    return _all_bands(spark, d).select("order_id", "total_amount", "order_category")


def q_product_category(spark, d):
    return _all_bands(spark, d).select("order_id", "product", "product_category")


def q_time_features(spark, d):
    return _all_bands(spark, d).select("order_id", "order_date", "day_of_week", "month", "quarter")


def q_profit(spark, d):
    return _all_bands(spark, d).select("order_id", "total_amount", "revenue", "estimated_profit")


def q_quality_flag(spark, d):
    return _all_bands(spark, d).select("order_id", "quantity", "price", "has_data_quality_issues")


def q_clean_filter(spark, d):
    return clean_filter(_raw(spark, d, P.AS_OF, P.AS_OF))


def q_null_fill(spark, d):
    return fill_nulls(_csv_frame(spark, d)).select(
        "order_id", "customer_id", "product", "quantity", "price", "order_date", "total_amount",
        "product_category")


# ---- aggregates --------------------------------------------------------------

def q_daily_summary(spark, d):
    return daily_summary(_report_input(spark, d, P.YESTERDAY, P.YESTERDAY), P.YESTERDAY, P.YESTERDAY)


def q_daily_summary_backfill(spark, d):
    return daily_summary(_report_input(spark, d))


def q_daily_summary_invalid(spark, d):
    """A6 with the invalid rows kept, so that issues are counted."""
    return daily_summary(_enriched(spark, d, keep_invalid=True, rank=False))


def q_fine_amounts(spark, d):
    """Amounts of four decimals: sum, mean and conditional sum."""
    items = TD.table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")), 4).alias("amount"))
    return items.groupBy("l_returnflag").agg(
        money_sum("amount").alias("total"), money_avg("amount").alias("mean"),
        money_sum_if(F.col("l_linestatus") == "F", "amount").alias("finished"))


def q_region_breakdown(spark, d):
    return breakdown(_report_input(spark, d), region_columns())


def q_channel_breakdown(spark, d):
    return breakdown(_report_input(spark, d), channel_columns())


def q_category_breakdown(spark, d):
    return breakdown(_report_input(spark, d), category_columns())


def q_current_month_sales(spark, d):
    return current_month_sales(_report_input(spark, d, P.MONTH_START, P.AS_OF), P.AS_OF)


def q_top_customers(spark, d):
    return top_customers(_report_input(spark, d, P.WINDOW_START, P.AS_OF), P.AS_OF)


def q_product_performance(spark, d):
    return product_performance(_report_input(spark, d, P.WINDOW_START, P.AS_OF), P.AS_OF)


def q_load_stats(spark, d):
    return load_stats(_report_input(spark, d, P.AS_OF, P.AS_OF), P.AS_OF)


def q_sales_report(spark, d):
    return sales_report(fill_nulls(_csv_frame(spark, d)))


def q_run_report(spark, d):
    """A10 over the whole frame, stamped with the run date."""
    return run_report(fill_nulls(_csv_frame(spark, d)), P.AS_OF)


def q_top_product(spark, d):
    return top_product(fill_nulls(_csv_frame(spark, d)))


def q_quality_profile(spark, d):
    return quality_profile(_report_input(spark, d))


def q_quality_profile_raw(spark, d):
    return quality_profile(_raw(spark, d))


def q_quality_nested(spark, d):
    """The nested result, its fields read back as columns."""
    nested = quality_struct(quality_profile(_report_input(spark, d)))
    return nested.select("total_records", "data_issues.*", "business_flags.*",
                         F.col("revenue_range.min").alias("min_revenue"),
                         F.col("revenue_range.max").alias("max_revenue"))


def q_gates(spark, d):
    return gates(_raw(spark, d))


def q_revenue_variance(spark, d):
    return revenue_variance(_report_input(spark, d))


# ---- users, snapshots, JSON --------------------------------------------------

def q_user_flatten(spark, d):
    return flatten_users(TD.user_docs_from_customer(spark, d))


def q_keyed_append(spark, d):
    batch = to_user_rows(flatten_users(TD.user_docs_from_orders(spark, d))
                         .withColumn("created_at", F.lit(None).cast("timestamp")))
    existing = to_user_rows(
        flatten_users(TD.user_docs_from_customer(spark, d, segment=P.EXISTING_SEGMENT))
        .withColumn("created_at", F.lit(None).cast("timestamp")))
    return new_rows_by_key(batch, existing, "id").select("id", "firstName", "lastName", "email")


def _latest(spark, d):
    return latest_snapshot(TD.snapshots_from_events(spark, d), P.SNAPSHOT_AS_OF)


def q_latest_snapshot(spark, d):
    return _latest(spark, d).select("user_id", "snapshot_ts", "snapshot_id")


def q_snapshot_location(spark, d):
    return split_snapshot(_latest(spark, d))[0]


def q_snapshot_login(spark, d):
    return split_snapshot(_latest(spark, d))[1]


def q_sales_to_json(spark, d):
    return records_to_json(_raw(spark, d))


def q_gen_sales(spark, d):
    orders = TD.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return generate_sales_for(orders, "o_orderkey", F.col("o_orderdate"), P.SEED)


def q_gen_sales_domains(spark, d):
    """Generated rows outside their domains, by rule."""
    rows = q_gen_sales(spark, d)
    amount_off = F.abs(F.col("total_amount") - F.round(F.col("quantity") * F.col("price"), 2)) > 1e-9
    lo, hi = PRICE_RANGE
    rules = {
        "bad_customers": ~F.col("customer_id").between(*CUSTOMER_ID_RANGE),
        "bad_products": ~F.col("product").isin(*PRODUCTS),
        "bad_quantities": ~F.col("quantity").between(*QUANTITY_RANGE),
        "bad_prices": ~F.col("price").between(lo, hi),
        "bad_amounts": amount_off,
        "bad_regions": ~F.col("region").isin(*REGIONS),
        "bad_channels": ~F.col("channel").isin(*CHANNELS),
        "bad_dates": F.col("order_date").isNull(),
    }
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("order_ids"),
                    *[F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()])


# ---- sinks, streaming, jobs (write under the work folder, read back) ----------

def q_csv_round_trip(spark, d):
    from ledgerline.sinks.files import write_csv
    path = scratch_path(spark, "csv")
    write_csv(TD.csv_sales_from_testdata(spark, d), path)
    return read_sales_csv(spark, path)


def q_csv_text_round_trip(spark, d):
    """S1 + K1 on free text: quotes, commas and line breaks in a field."""
    from ledgerline.sinks.files import write_csv
    path = scratch_path(spark, "csv-text")
    docs = TD.table(spark, d, "documents").select("doc_id", "lang", "text")
    write_csv(docs, path)
    return read_csv(spark, path, docs.schema, multiline=True)


def q_snapshot_files(spark, d):
    """Snapshot documents written under a dated path, read back with
    the time from the path; the first result's city per document."""
    path = scratch_path(spark, "snapshots")
    latest = _latest(spark, d)
    latest.select(F.col("doc").alias("value"), F.lit(P.SNAPSHOT_AS_OF.isoformat(sep=" ")).alias("taken")) \
        .write.partitionBy("taken").text(path)
    docs = read_snapshots(spark, path, multiline=False, ts_col="taken")
    return docs.select("snapshot_ts", F.get("results", 0)["location"]["city"].alias("city"),
                       F.get("results", 0)["login"]["uuid"].alias("uuid"))


def q_truncate_users(spark, d):
    """K9: a keyed table, filled and truncated, stays readable; refilled with
    one segment it holds just that."""
    from ledgerline.sinks.files import append_by_key, read_users, truncate_table
    path = scratch_path(spark, "truncated")
    users = flatten_users(TD.user_docs_from_customer(spark, d))
    append_by_key(users, path, created_at=P.USER_STAMP)
    truncate_table(spark, path, schemas.USERS)
    left = read_users(spark, path).count()
    append_by_key(flatten_users(TD.user_docs_from_customer(spark, d, segment=P.EXISTING_SEGMENT)), path,
                  created_at=P.USER_STAMP)
    return read_users(spark, path).agg(F.lit(left).cast("bigint").alias("after_truncate"),
                                       F.count(F.lit(1)).alias("after_refill"))


def q_incremental_ingest(spark, d):
    """Two arrivals: files up to the as-of date, then the rest. Each run
    ingests only the files it has not seen; a third run with nothing new
    adds nothing. The table ends with every row exactly once."""
    from ledgerline.streaming.ingest import ingest_new_files
    base = scratch_path(spark, "ingest")
    raw = _raw(spark, d)
    raw.filter(F.col("order_date") <= F.lit(P.AS_OF)).write.json(f"{base}/landing/batch=1")
    args = dict(source_dir=f"{base}/landing/*", target=f"{base}/table",
                checkpoint=f"{base}/checkpoint")
    ingest_new_files(spark, **args)
    raw.filter(F.col("order_date") > F.lit(P.AS_OF)).write.json(f"{base}/landing/batch=2")
    ingest_new_files(spark, **args)
    ingest_new_files(spark, **args)
    return spark.read.parquet(f"{base}/table").select(*RAW_COLUMNS)


def q_idempotent_summary(spark, d):
    from ledgerline.sinks.files import write_summary
    path = scratch_path(spark, "summary")
    summary = daily_summary(_report_input(spark, d))
    write_summary(summary, path)
    write_summary(summary, path)  # rerun: same partitions replaced, no doubles
    out = spark.read.schema(schemas.DAILY_SUMMARY_TABLE).parquet(path)
    return out.select(*[f.name for f in schemas.DAILY_SUMMARY.fields])


def q_backup_copy(spark, d):
    from ledgerline.sinks.files import backup, write_transformed
    base = scratch_path(spark, "backup")
    write_transformed(_enriched(spark, d), f"{base}/transformed")
    dest = backup(spark, f"{base}/transformed", base, P.AS_OF, schemas.TRANSFORMED_SALES, "order_date")
    return spark.read.schema(schemas.TRANSFORMED_SALES).parquet(dest).select(*ENRICHED_OUT)


def q_retention_90(spark, d):
    from ledgerline.sinks.files import expire, write_transformed
    path = scratch_path(spark, "retention")
    write_transformed(_enriched(spark, d), path)
    expire(spark, path, P.AS_OF, P.RETENTION_DAYS)
    return spark.read.schema(schemas.TRANSFORMED_SALES).parquet(path).select(*ENRICHED_OUT)


def q_run_status(spark, d):
    from ledgerline.plans.jobs import run_daily
    base = scratch_path(spark, "daily")
    return run_daily(spark, _raw(spark, d, P.AS_OF, P.AS_OF), base, P.AS_OF, exact=False)


def q_csv_report_job(spark, d):
    from ledgerline.plans.jobs import run_csv_report
    from ledgerline.sinks.files import write_csv
    base = scratch_path(spark, "csvjob")
    write_csv(TD.csv_sales_from_testdata(spark, d), f"{base}/raw_csv")
    return run_csv_report(spark, f"{base}/raw_csv", f"{base}/out", None)


def q_user_ingest_job(spark, d):
    """Documents land as JSON lines; the job runs twice and the second run
    adds nothing (keys already stored)."""
    from ledgerline.plans.jobs import run_users
    from ledgerline.sinks.files import read_users
    base = scratch_path(spark, "users")
    TD.user_docs_from_customer(spark, d).write.text(f"{base}/docs")
    run_users(spark, f"{base}/docs", f"{base}/table", multiline=False)
    run_users(spark, f"{base}/docs", f"{base}/table", multiline=False)
    return read_users(spark, f"{base}/table").select("id", "firstName", "lastName", "email")


def q_user_stamp(spark, d):
    """Flattened users stamped with a fixed load time as text."""
    from ledgerline.operators.users import stamp_created
    return stamp_created(flatten_users(TD.user_docs_from_customer(spark, d)), P.USER_STAMP)


def q_report_json(spark, d):
    """K7: the per-date reports written as JSON and read back."""
    from ledgerline.sinks.files import write_report
    path = scratch_path(spark, "report")
    report = sales_report(fill_nulls(_csv_frame(spark, d)))
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


def q_sql_views(spark, d):
    """The three views registered over the transformed rows, each read
    back through SQL."""
    from ledgerline.plans.views import register_views
    register_views(_report_input(spark, d), P.AS_OF)
    return spark.sql("""
        SELECT 'current_month_sales' AS view, CAST(order_date AS STRING) AS item, orders AS n,
               revenue AS total, avg_order_value AS mean FROM current_month_sales
        UNION ALL SELECT 'top_customers', CAST(customer_id AS STRING), order_count, total_spent,
               avg_order_value FROM top_customers
        UNION ALL SELECT 'product_performance', concat(product, '/', product_category), times_sold,
               total_revenue, avg_price FROM product_performance""")


def q_partitioned_scan(spark, d):
    """K3 + S2: the raw table written partitioned by order_date, then one
    date read back through partition pruning."""
    from ledgerline.sinks.files import write_raw
    from ledgerline.sources.tables import scan_sales
    path = scratch_path(spark, "raw")
    write_raw(_raw(spark, d), path)
    return scan_sales(spark, path, P.AS_OF, P.AS_OF, columns=list(RAW_COLUMNS),
                      schema=schemas.RAW_SALES_TABLE)


# ---- run dates, stamps, messages -----------------------------------------------

def q_run_dates(spark, d):
    """Dates from ISO timestamp texts, against a run date given as such a
    text and against the default run date, today."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    days = TD.table(spark, d, "events").select(iso_date(text).alias("day"))
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("events")).select(
        "day", "events", (F.col("day") == as_date(P.EVENT_DAY_TEXT)).alias("is_run_date"),
        (F.col("day") < as_date(None)).alias("is_past"))


def q_insert_stamps(spark, d):
    """K12 + P10: rows inserted without a stamp get the default of the DDL;
    enriched rows are stamped. Rows, and those with a stamp of this run."""
    path, name = scratch_path(spark, "defaults"), f"ledgerline_{uuid.uuid4().hex}"
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    rows = _raw(spark, d)
    rows.createOrReplaceTempView(f"{name}_rows")
    spark.sql(schemas.ddl(name, schemas.RAW_SALES_TABLE, path))
    columns = ", ".join(RAW_COLUMNS)
    spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {name}_rows")
    spark.sql(f"DROP TABLE {name}")
    spark.catalog.dropTempView(f"{name}_rows")
    stored = spark.read.schema(schemas.RAW_SALES_TABLE).parquet(path)
    made = enrich(rows, with_sequence=False)
    count = lambda df, what, stamp: df.agg(
        F.lit(what).alias("rows_of"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(stamp) >= F.lit(began)).alias("stamped"))
    return count(stored, "insert", "created_at").unionByName(count(made, "enrich", "processed_at"))


def q_processed_message(spark, d):
    """The extract step's text over the per-date reports."""
    from ledgerline.plans.jobs import processed_message
    return processed_message(sales_report(fill_nulls(_csv_frame(spark, d))))


# ---- state kept between runs ---------------------------------------------------

def q_customer_order_sequence_ranges(spark, d):
    """W1 in one pass: range partitions, totals carried across borders."""
    return enrich(_raw(spark, d), stamp=False, in_ranges=True).select(
        "customer_id", "order_date", "order_id", "product", "quantity", "customer_order_sequence")


def q_ingest_counts(spark, d):
    """Rows stored per run, by the sink's commit log. The second run is
    called twice under its id, the last finds nothing new."""
    from ledgerline.streaming.ingest import ingest_new_files
    base = scratch_path(spark, "ingest-counts")
    raw = _raw(spark, d)
    args = dict(source_dir=f"{base}/landing/*", target=f"{base}/table", checkpoint=f"{base}/checkpoint")
    raw.filter(F.col("order_date") <= F.lit(P.AS_OF)).write.json(f"{base}/landing/batch=1")
    found = [("first", ingest_new_files(spark, **args, run_id="first"))]
    raw.filter(F.col("order_date") > F.lit(P.AS_OF)).write.json(f"{base}/landing/batch=2")
    for name, run_id in (("second", "second"), ("second again", "second"), ("third", "third")):
        found.append((name, ingest_new_files(spark, **args, run_id=run_id)))
    return spark.createDataFrame(found, "run string, stored long")


def q_append_filtered(spark, d):
    """K8: a batch per market segment, then all customers with an order; the
    filters name the folders to compare with. Every key once."""
    from ledgerline.sinks.files import append_by_key, read_users
    path = scratch_path(spark, "append-filtered")
    for segment in P.STORED_SEGMENTS:
        append_by_key(flatten_users(TD.user_docs_from_customer(spark, d, segment=segment)), path,
                      created_at=P.USER_STAMP)
    append_by_key(flatten_users(TD.user_docs_from_orders(spark, d)), path, created_at=P.USER_STAMP)
    return read_users(spark, path).select("id", "firstName", "lastName", "email")


def q_snapshot_as_of_event(spark, d):
    """W2 at each event's own time: the user's latest signup at or before."""
    events = TD.table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    signups = events.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("snapshot_ts"), F.col("event_id").alias("snapshot_id"))
    return as_of_join(events, signups, "user_id", "ts", "snapshot_ts", "snapshot_id")


def q_incremental_summary(spark, d):
    """A2 + K5 batch by batch; the last batch brings late rows for all
    dates, and one batch is delivered twice."""
    from ledgerline.sinks.summary_state import apply_batch, read_summary
    path = scratch_path(spark, "incremental")
    rows, part = _report_input(spark, d), F.pmod(F.col("order_id"), F.lit(10))
    for batch, share in enumerate((part < 6, part.between(6, 8), part == 9)):
        apply_batch(rows.where(share), path, batch)
    apply_batch(rows.where(part.between(6, 8)), path, 1)
    return read_summary(spark, path)


#: Bytes of line items (Parquet) to a file that arrives, and to a write of
#: such files.
ARRIVAL_BYTES = 4 << 20
ARRIVAL_SLICE = 32 << 20


def q_stream_summary(spark, d):
    """T1 + A2: files that hold all dates, taken in over several
    micro-batches and two runs."""
    from ledgerline.sinks.summary_state import read_summary
    from ledgerline.streaming.summary import stream_summary
    base = scratch_path(spark, "stream-summary")
    raw, part = _raw(spark, d), F.pmod(F.col("order_id"), F.lit(10))
    size = input_bytes(spark, f"{d}/lineitem.parquet")
    # Each arrival's five tenths are written in up to five goes: the shuffle
    # files of one go before the next one's come.
    slices = min(5, -(-size // ARRIVAL_SLICE))
    files = max(3, -(-size // (ARRIVAL_BYTES * slices)))
    for n in range(2):
        for k in range(slices):
            share = part.isin(*range(5 * n + k, 5 * n + 5, slices))
            (raw.where(share).repartition(files)
             .write.mode("append").option("compression", "gzip").json(f"{base}/landing/arrival={n}"))
            free_shuffles(spark)
        stream_summary(spark, f"{base}/landing/*", f"{base}/summary", f"{base}/checkpoint",
                       lateness="36500 days", max_files_per_trigger=-(-2 * files * slices // 3))
        free_shuffles(spark)
    return read_summary(spark, f"{base}/summary")


def q_clustered_scan(spark, d):
    """K4 along the curve, read back with a filter on both columns."""
    from ledgerline.sinks.files import write_transformed
    path = scratch_path(spark, "clustered")
    write_transformed(_enriched(spark, d), path, curve=True)
    rows = spark.read.schema(schemas.TRANSFORMED_SALES).parquet(path)
    return rows.where((F.col("region") == P.CLUSTER_REGION)
                      & F.col("product").startswith(P.CLUSTER_PRODUCT_PREFIX)).select(*ENRICHED_OUT)


def q_quarantine(spark, d):
    """S4 with rejects: JSON lines of which some are cut off and some hold a
    text for a number; every record comes back as a row or a reject."""
    from ledgerline.sources.quarantine import read_rejects, read_rows, take_in
    base = scratch_path(spark, "quarantine")
    raw = _raw(spark, d)
    kind = F.pmod(F.col("order_id"), F.lit(50))
    line = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    raw.select(F.when(kind == 7, F.substring(line, 1, 30))
               .when(kind == 8, F.replace(line, F.lit('"quantity":'), F.lit('"quantity":"x","q":')))
               .otherwise(line).alias("value")).write.text(f"{base}/in")
    take_in(spark, f"{base}/in", f"{base}/table", schemas.RAW_SALES)
    rows = read_rows(spark, f"{base}/table", schemas.RAW_SALES).select(
        *RAW_COLUMNS, F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("text"))
    rejects = read_rejects(spark, f"{base}/table", schemas.RAW_SALES).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW_SALES.fields],
        F.col("reject_reason").alias("reason"), F.col("reject_text").alias("text"))
    return rows.unionByName(rejects)


def q_scan_dates(spark, d):
    """S3 over a list of dates: all sales of the days with a large order."""
    from ledgerline.sinks.files import write_raw
    from ledgerline.sources.tables import scan_dates
    path = scratch_path(spark, "raw-dates")
    write_raw(_raw(spark, d), path)
    days = TD.table(spark, d, "orders").where(F.col("o_totalprice") > P.LARGE_ORDER).select("o_orderdate")
    return scan_dates(spark, path, days, list(RAW_COLUMNS), schema=schemas.RAW_SALES_TABLE)


def q_resumed_run(spark, d):
    """A run that fails at its quality gate and is taken up there; the
    status, and how often each step ran."""
    from ledgerline.plans.jobs import run_daily
    from ledgerline.plans.ledger import read_ledger
    base = scratch_path(spark, "resumed")
    raw = _raw(spark, d, P.AS_OF, P.AS_OF)
    run_daily(spark, raw, base, P.AS_OF, gate_on=("total_records",), resume=True)
    status = run_daily(spark, raw, base, P.AS_OF, exact=False, resume=True)
    steps = F.array_sort(F.collect_list(F.concat_ws(":", "step", "runs")))
    told = read_ledger(spark, f"{base}/run_ledger").agg(F.array_join(steps, ",")).first()[0]
    return status.drop("quality_checks").withColumn("steps", F.lit(told))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

# Headline queries for the bench: the flagship and the reports.
HEADLINE = ("enrich_range", "customer_order_sequence", "daily_summary_backfill", "top_customers",
            "product_performance", "current_month_sales", "quality_profile_raw", "sales_report",
            "gates", "revenue_variance", "latest_snapshot", "keyed_append", "user_flatten")

# Timed beside them: queries whose feature is a write.
WRITERS = ("user_ingest_job", "report_json", "idempotent_summary", "retention_90")
