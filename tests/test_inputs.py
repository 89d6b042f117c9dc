"""Input that is broken, late or odd never vanishes without an error."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.money import money_avg, money_sum, money_sum_if
from ledgerline.operators.reports import daily_summary, revenue_variance, run_report, sales_report
from ledgerline.operators.enrich import enrich
from ledgerline.plans.jobs import processed_message, run_csv_report, run_daily, run_users
from ledgerline.sinks.files import (
    append_by_key, backup, expire, read_users, truncate_table, write_csv, write_raw, write_summary,
)
from ledgerline.sources.files import read_csv, read_raw_json, read_sales_csv, read_snapshots, read_user_docs
from ledgerline.streaming.ingest import ingest_new_files
from tests.conftest import RUN_DATE, raw_rows

DAY = dt.date(2024, 1, 15)


def sale(i, date=DAY, amount=2.0):
    return (i, 1, "Widget A", 1, amount, amount, date, "North", "Online")


def landed(i, date="2024-01-15"):
    return json.dumps({"order_id": i, "customer_id": 1, "product": "p", "quantity": 1, "price": 2.0,
                       "total_amount": 2.0, "order_date": date, "region": "North", "channel": "Online"})


def put(path, text, mtime=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if mtime:
        os.utime(path, (mtime, mtime))


def test_ingest_counts_more_batches_than_spark_keeps_reports_of(spark, tmp_path):
    for i in range(120):
        put(tmp_path / "in" / f"{i}.json", landed(i))
    got = ingest_new_files(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"),
                           max_files_per_trigger=1, writers=1)
    assert got == 120 == spark.read.parquet(str(tmp_path / "t")).count()


def test_ingest_reads_a_late_file_with_an_old_time(spark, tmp_path):
    run = lambda: ingest_new_files(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"))
    put(tmp_path / "in" / "new.json", landed(1))
    assert run() == 1
    put(tmp_path / "in" / "old.json", landed(2), mtime=dt.datetime.now().timestamp() - 30 * 86400)
    assert run() == 1
    assert {r.order_id for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {1, 2}


def test_broken_records_fail(spark, tmp_path):
    put(tmp_path / "raw" / "a.json", landed(1) + '\n{"order_id": 2, "cust\n')
    with pytest.raises(Exception):
        read_raw_json(spark, str(tmp_path / "raw")).collect()
    with pytest.raises(Exception):
        ingest_new_files(spark, str(tmp_path / "raw"), str(tmp_path / "t"), str(tmp_path / "c"))
    assert not (tmp_path / "t").exists() or spark.read.schema(schemas.RAW_SALES).parquet(str(tmp_path / "t")).count() == 0
    put(tmp_path / "typed" / "a.json", landed(1).replace('"quantity": 1', '"quantity": "many"'))
    with pytest.raises(Exception):
        read_raw_json(spark, str(tmp_path / "typed")).collect()
    put(tmp_path / "docs" / "a.json", '{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception):
        read_user_docs(spark, str(tmp_path / "docs"), multiline=False).collect()
    put(tmp_path / "snaps" / "a.json", '{"results": 5}')
    with pytest.raises(Exception):
        read_snapshots(spark, str(tmp_path / "snaps"), multiline=False).collect()


@pytest.mark.parametrize("bad", ['{"personalInfo": {"firstName": "x"}}', '{"id": "2", "personalInfo": 7}', "{"])
def test_users_without_id_or_broken_fail_the_job(spark, tmp_path, bad):
    put(tmp_path / "docs" / "a.json", '{"id": "1"}\n' + bad)
    with pytest.raises(Exception):
        run_users(spark, str(tmp_path / "docs"), str(tmp_path / "t"), multiline=False)
    assert read_users(spark, str(tmp_path / "t")).count() == 0


def test_snapshot_time_from_the_path(spark, tmp_path):
    put(tmp_path / "taken=2024-01-02 03%3A04%3A05" / "a.json", '{"results": []}')
    (row,) = read_snapshots(spark, str(tmp_path), multiline=False, ts_col="taken").collect()
    assert row.snapshot_ts == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_csv_columns_come_by_header_name(spark, tmp_path):
    put(tmp_path / "a" / "x.csv", "customer_id,order_id,product,quantity,price,order_date,note\n"
                                  '7,1,"Widget ""A"", big",2,1.5,2024-01-15,hm\n')
    (row,) = read_sales_csv(spark, str(tmp_path / "a")).collect()
    assert tuple(row) == (1, 7, 'Widget "A", big', 2, 1.5, DAY)
    put(tmp_path / "b" / "x.csv", "order_id,customer_id,product,quantity,price\n1,7,p,2,1.5\n")
    with pytest.raises(ValueError, match="order_date"):
        read_sales_csv(spark, str(tmp_path / "b"))
    put(tmp_path / "a" / "y.csv", "order_id,customer_id,product,quantity,price,order_date,note\n2,8,p,1,1.0,2024-01-15,x\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, str(tmp_path / "a")).collect()


def test_csv_round_trip_of_odd_text(spark, tmp_path):
    texts = ['a "quoted" word', "two\nlines", "comma, comma", "  spaces  ", "", None, '"', '\\"', "tab\tend\\", 'x""y\n"z"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    write_csv(df, str(tmp_path / "c"))
    got = dict(map(tuple, read_csv(spark, str(tmp_path / "c"), df.schema, multiline=True).collect()))
    # An empty field is a missing value, as in the original's CSV reader.
    assert got == {k: t or None for k, t in enumerate(texts)}


def test_amounts_of_any_number_of_cents(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"), (F.col("id") % 2 == 0).alias("even"))
    row = small.agg(money_sum("x").alias("s"), money_avg("x").alias("a"), money_sum_if(F.col("even"), "x").alias("e")).first()
    assert tuple(row) == (4.0, 0.004, 2.0)
    mixed = spark.createDataFrame([(1234567.891234,), (-0.000001,), (-5.25,), (None,), (1e9,)], "x double")
    assert mixed.agg(money_sum("x")).first()[0] == 1001234562.641233
    assert spark.createDataFrame([(None,)], "x double").agg(money_sum("x")).first()[0] is None
    with pytest.raises(Exception, match="more than 6 decimals"):
        spark.createDataFrame([(1 / 3,)], "x double").agg(money_sum("x")).collect()


def test_report_keeps_rows_without_a_date(spark):
    df = spark.createDataFrame([(1, 5, "b", 2, 2.0, DAY, 4.0), (2, 5, "a", 2, 1.0, None, 2.0),
                                (3, None, "a", 1, 1.0, None, 1.0)],
                               "order_id long, customer_id long, product string, quantity long, price double, "
                               "order_date date, total_amount double")
    got = {r.date: tuple(r)[1:] for r in sales_report(df).collect()}
    assert got == {"2024-01-15": (1, 4.0, 4.0, "b", 1), None: (2, 3.0, 1.5, "a", 1)}
    (whole,) = run_report(df, DAY).collect()
    assert tuple(whole) == ("2024-01-15", 3, 7.0, 7.0 / 3, "a", 1)
    days = {r.order_date: (r.revenue, r.previous_revenue) for r in revenue_variance(df).collect()}
    assert days == {DAY: (4.0, None), None: (3.0, None)}
    (empty,) = run_report(df.limit(0), DAY).collect()
    assert (empty.total_orders, empty.total_revenue, empty.top_product) == (0, None, None)


def test_csv_job_reports_the_whole_file_under_the_run_date(spark, golden, tmp_path):
    two_days = golden.unionByName(golden.withColumn("order_date", F.date_sub("order_date", 1)))
    write_csv(two_days, str(tmp_path / "in"))
    (row,) = run_csv_report(spark, str(tmp_path / "in"), str(tmp_path / "out"), RUN_DATE).collect()
    assert row.date == RUN_DATE.isoformat() and row.total_orders == 10
    text = processed_message(spark.createDataFrame([row])).first().message
    assert text == f"Processed 10 records, total revenue: ${row.total_revenue:.2f}"


def test_daily_job_summarises_yesterday_and_keeps_what_it_did_not_compute(spark, tmp_path):
    base, before = str(tmp_path), DAY - dt.timedelta(days=1)
    first = run_daily(spark, raw_rows(spark, [sale(1, before)]), base, before).first()
    assert first.status == "success" and json.loads(first.quality_checks)["total_records"] == 1
    read = lambda: {r.summary_date: r.total_orders for r in spark.read.schema(
        schemas.DAILY_SUMMARY_TABLE).parquet(f"{base}/daily_summary").collect()}
    run_daily(spark, raw_rows(spark, [sale(2), sale(3)]), base, DAY)
    assert read() == {before: 1}
    run_daily(spark, raw_rows(spark, [sale(2)]), base, DAY, mode="replace")
    assert read() == {before: 1}
    run_daily(spark, raw_rows(spark, [sale(2)]), base, DAY, summary_date=DAY)
    assert read() == {before: 1, DAY: 1}


def test_kept_invalid_rows_count_as_issues(edge_raw):
    rows = daily_summary(enrich(edge_raw, keep_invalid=True, stamp=False)).collect()
    assert sum(r.data_quality_issues_count for r in rows) == 3


def test_backup_keeps_partitions_and_expiry_survives_missing_dates(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_raw(raw_rows(spark, [sale(1), sale(2, dt.date(2023, 1, 1)), sale(3, None)]), path)
    dest = backup(spark, path, str(tmp_path), DAY, schemas.RAW_SALES_TABLE, "order_date")
    names = {n for n in os.listdir(dest) if n.startswith("order_date=")}
    assert names == {n for n in os.listdir(path) if n.startswith("order_date=")} and len(names) == 3
    assert expire(spark, path, DAY, 90) == 1
    assert sorted(str(r.order_id) for r in spark.read.parquet(path).collect()) == ["1", "3"]


def test_keyed_table_writes_once_and_truncates(spark, tmp_path):
    path = str(tmp_path / "users")
    batch = lambda *ids: spark.createDataFrame([(str(i), "a", "b", "c") for i in ids],
                                               "id string, firstname string, lastname string, email string")
    assert append_by_key(batch(1, 2), path, created_at=dt.datetime(2024, 1, 1)).count() == 2
    assert append_by_key(batch(2, 3), path, created_at=dt.datetime(2024, 1, 1)).count() == 1
    assert os.listdir(path) == ["data"] and len(os.listdir(f"{path}/data")) == 2
    truncate_table(spark, path, schemas.USERS)
    assert read_users(spark, path).count() == 0
    assert append_by_key(batch(2), path, created_at=dt.datetime(2024, 1, 1)).count() == 1


def test_ddl_defaults(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS defaults_t")
    spark.sql(schemas.ddl("defaults_t", schemas.USERS, str(tmp_path / "t")))
    spark.sql("INSERT INTO defaults_t (id) VALUES (1)")
    row = spark.table("defaults_t").first()
    assert row.id == 1 and row.firstName is None and row.created_at is not None
    spark.sql("DROP TABLE defaults_t")


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from ledgerline.session import work_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                              getConf=lambda: SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(SimpleNamespace(sparkContext=context))
