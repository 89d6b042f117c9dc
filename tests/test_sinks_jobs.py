import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.enrich import enrich
from ledgerline.operators.reports import daily_summary
from ledgerline.plans.jobs import run_csv_report, run_daily
from ledgerline.plans.views import register_views
from ledgerline.sinks.files import (
    backup, expire, partition_dates, truncate_table, write_csv, write_summary, write_transformed,
)
from ledgerline.sources.files import read_sales_csv
from ledgerline.sources.generate import generate_sales
from ledgerline.sources.tables import scan_sales
from ledgerline.streaming.ingest import ingest_new_files
from tests.conftest import RUN_DATE, raw_rows


def _sales(spark, days=3, per_day=4):
    rows = []
    for d in range(days):
        for i in range(per_day):
            rows.append((d * 100 + i, 100 + i, "Widget A", 1 + i, 20.0, 20.0 * (1 + i),
                         dt.date(2024, 1, 1 + d), "North", "Online"))
    return raw_rows(spark, rows)


def test_dynamic_overwrite_is_idempotent_and_drops_empty_rerun(spark, tmp_path):
    path = str(tmp_path / "summary")
    enr = enrich(_sales(spark), stamp=False)
    s = daily_summary(enr)
    write_summary(s, path)
    write_summary(s, path)
    assert spark.read.parquet(path).count() == 3
    # rerun of Jan 2 that yields no rows removes that date only
    write_summary(daily_summary(enr.filter("order_date = '2030-01-01'")), path,
                  dates=[dt.date(2024, 1, 2)])
    assert sorted(r.summary_date.day for r in spark.read.parquet(path).collect()) == [1, 3]


def test_partition_pruning_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    write_transformed(enrich(_sales(spark, days=5), stamp=False), path)
    day = scan_sales(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert day.count() == 4
    assert expire(spark, path, dt.date(2024, 1, 5), 2) == 2
    assert [d.day for d in partition_dates(spark, path, "order_date")] == [3, 4, 5]
    dest = backup(spark, path, str(tmp_path), dt.date(2024, 1, 5))
    assert dest.endswith("backup_20240105") and spark.read.parquet(dest).count() == 12
    truncate_table(spark, path, schemas.TRANSFORMED_SALES)
    assert spark.read.parquet(path).count() == 0


def test_views(spark):
    views = register_views(enrich(_sales(spark), stamp=False), dt.date(2024, 1, 3))
    assert spark.sql("select count(*) from current_month_sales").first()[0] == 3
    assert set(views) == {"current_month_sales", "top_customers", "product_performance"}


def test_incremental_ingest_each_file_once(spark, tmp_path):
    src, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)

    def put(name, rows):
        with open(os.path.join(src, name), "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")

    rec = {"order_id": 1, "customer_id": 5, "product": "Widget A", "quantity": 1, "price": 2.0,
           "total_amount": 2.0, "order_date": "2024-01-15", "region": "North", "channel": "Online"}
    put("a.json", [rec, {**rec, "order_id": 2}])
    assert ingest_new_files(spark, src, target, ckpt) == 2
    assert ingest_new_files(spark, src, target, ckpt) == 0
    assert spark.read.parquet(target).count() == 2
    put("b.json", [{**rec, "order_id": 3}])
    ingest_new_files(spark, src, target, ckpt)
    assert sorted(r.order_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_generate_sales_deterministic(spark):
    a = generate_sales(spark, RUN_DATE, 50, seed=7)
    rows = a.collect()
    assert rows == generate_sales(spark, RUN_DATE, 50, seed=7).collect()
    assert len(rows) == 50 and rows[0].order_id == 1000
    assert all(1 <= r.quantity <= 5 and 19.99 <= r.price <= 99.99 and 100 <= r.customer_id <= 999
               for r in rows)
    assert all(r.total_amount == round(r.quantity * r.price, 2) for r in rows)
    assert {r.order_date for r in rows} == {RUN_DATE}


def test_run_daily_success_error_and_rerun(spark, tmp_path):
    raw = generate_sales(spark, RUN_DATE, 40, seed=3)
    base = str(tmp_path / "wh")
    ok = run_daily(spark, raw, base, RUN_DATE, exact=False, summary_date=RUN_DATE).first()
    assert ok.status == "success" and ok.records_processed == 40
    again = run_daily(spark, raw, base, RUN_DATE, exact=False, summary_date=RUN_DATE).first()
    assert again.records_processed == 40                      # rerun replaces, no doubling
    assert spark.read.parquet(f"{base}/raw_sales").count() == 40
    assert spark.read.parquet(f"{base}/daily_summary").count() == 1
    bad = raw.withColumn("total_amount", F.col("total_amount") + 1)
    err = run_daily(spark, bad, base, RUN_DATE, exact=True).first()
    assert err.status == "error" and "Data quality issues found" in err.error


def test_csv_report_job(spark, golden, tmp_path):
    src = str(tmp_path / "raw_csv")
    write_csv(golden, src)
    assert read_sales_csv(spark, src).count() == 5
    rep = run_csv_report(spark, src, str(tmp_path / "out"), RUN_DATE).first()
    assert rep.top_product == "Widget A" and rep.total_orders == 5
    assert abs(rep.total_revenue - 319.91) < 1e-9
    assert os.path.isdir(str(tmp_path / "out" / "backup_20240115"))


def test_literal_modes_replace_and_append(spark, tmp_path):
    from ledgerline.sinks.files import write_raw
    path = str(tmp_path / "t")
    enr = enrich(_sales(spark, days=3), stamp=False)
    write_transformed(enr, path)
    write_transformed(enr.filter("order_date = '2024-01-03'"), path, mode="replace")
    assert [d.day for d in partition_dates(spark, path, "order_date")] == [3]   # keeps one day
    raw_path = str(tmp_path / "raw")
    write_raw(_sales(spark, days=1), raw_path, append=True)
    write_raw(_sales(spark, days=1), raw_path, append=True)
    assert spark.read.parquet(raw_path).count() == 8                           # rerun doubles
    write_raw(_sales(spark, days=1), raw_path)
    assert spark.read.parquet(raw_path).count() == 4                           # default replaces


def test_run_daily_empty_rerun_clears_the_day(spark, tmp_path):
    raw = generate_sales(spark, RUN_DATE, 10, seed=5)
    base = str(tmp_path / "wh")
    assert run_daily(spark, raw, base, RUN_DATE, exact=False).first().status == "success"
    err = run_daily(spark, raw.limit(0), base, RUN_DATE, exact=False).first()
    assert err.status == "error" and err.error == "No records found for transformation"
    assert spark.read.schema(schemas.RAW_SALES_TABLE).parquet(f"{base}/raw_sales").count() == 0
    assert spark.read.schema(schemas.TRANSFORMED_SALES).parquet(f"{base}/transformed_sales").count() == 0


def test_layout_splits_hot_date_and_keeps_quiet_dates_whole(spark, tmp_path):
    """A third of the rows on one date: that date is written by several
    tasks; every other date is one file; no row is lost."""
    import glob
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        n = 90_000
        hot = F.col("id") % 3 == 0
        raw = spark.range(0, n, 1, 4).select(
            F.col("id").alias("order_id"), (F.col("id") % 500).alias("customer_id"),
            F.concat(F.lit("Widget "), (F.col("id") % 7).cast("string")).alias("product"),
            (F.col("id") % 5 + 1).alias("quantity"), F.lit(20.0).alias("price"),
            ((F.col("id") % 5 + 1) * 20.0).alias("total_amount"),
            F.date_add(F.lit(dt.date(2024, 1, 1)),
                       F.when(hot, F.lit(0)).otherwise(F.col("id") % 30 + 1).cast("int")).alias("order_date"),
            F.lit("North").alias("region"), F.lit("Online").alias("channel"))
        path = str(tmp_path / "t")
        write_transformed(enrich(raw, stamp=False, with_sequence=False), path)
        files = {}
        for f in glob.glob(f"{path}/order_date=*/*.parquet"):
            files.setdefault(f.split("/")[-2], []).append(f)
        bucket = {str(r.order_date): r.b for r in raw.select("order_date").distinct().select(
            "order_date", F.pmod(F.hash("order_date"), F.lit(64)).alias("b")).collect()}
        hot_bucket = bucket["2024-01-01"]
        assert len(files["order_date=2024-01-01"]) >= 2
        # a date that shares the hot date's hash bucket is split with it
        assert all(len(v) == 1 for k, v in files.items()
                   if bucket[k.split("=")[1]] != hot_bucket)
        assert spark.read.parquet(path).count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_requested_date_kept_when_frame_has_more_dates(spark, tmp_path):
    """Asking to replace one date of a multi-date frame keeps every date the
    frame wrote; only a requested date with no rows loses its folder."""
    path = str(tmp_path / "t")
    enr = enrich(_sales(spark, days=6), stamp=False)
    write_transformed(enr, path)
    last = dt.date(2024, 1, 6)
    write_transformed(enr, path, dates=[last])
    assert last in partition_dates(spark, path, "order_date")
    assert spark.read.parquet(path).count() == 24
    # rerun of Jan 3 with no rows: that folder goes, the others stay
    write_transformed(enr.filter("order_date = '2030-01-01'"), path, dates=[dt.date(2024, 1, 3)])
    assert dt.date(2024, 1, 3) not in partition_dates(spark, path, "order_date")
    assert len(partition_dates(spark, path, "order_date")) == 5
