import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.enrich import enrich
from ledgerline.plans.jobs import run_daily
from ledgerline.plans.ledger import read_ledger, rows_fingerprint
from ledgerline.sinks.clustering import along_curve, file_ranges, files_hit, splitters
from ledgerline.sinks.files import _layout, write_raw, write_transformed
from ledgerline.sources.generate import generate_sales
from ledgerline.sources.quarantine import (
    NOT_CSV, NOT_JSON, NOT_TYPED, TooManyRejects, read_rejects, read_rows, take_in,
)
from ledgerline.sources.tables import scan_dates
from tests.conftest import RUN_DATE, raw_rows

# ---- clustering ------------------------------------------------------------


@pytest.fixture(scope="module")
def big_day(spark):
    """One date, 40 regions and 40 products, in every combination."""
    return spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("order_id"), (F.col("id") % 500).alias("customer_id"),
        F.format_string("Widget %02d", F.pmod(F.xxhash64("id"), F.lit(40))).alias("product"),
        F.lit(2).cast("long").alias("quantity"), F.lit(3.0).alias("price"), F.lit(6.0).alias("total_amount"),
        F.lit(dt.date(2024, 1, 1)).alias("order_date"),
        F.format_string("R%02d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))).alias("region"),
        F.lit("Online").alias("channel"))


def test_curve_skips_files_on_either_column(spark, big_day, tmp_path):
    enriched = enrich(big_day, stamp=False, with_sequence=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        plain, curved = str(tmp_path / "plain"), str(tmp_path / "curved")
        _layout(enriched, "order_date", ("region", "product"), "order_id").write.partitionBy("order_date").parquet(plain)
        write_transformed(enriched, curved, curve=True, files=32)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    ranges = {n: file_ranges(spark.read.parquet(p), ("region", "product")).cache()
              for n, p in (("plain", plain), ("curved", curved))}
    share = lambda n, **v: (lambda hit, all_: hit / all_)(*files_hit(ranges[n], **v))
    assert files_hit(ranges["plain"], region="R11")[1] >= 8
    both = {"region": "R11", "product": "Widget 23"}
    assert share("curved", **both) < share("plain", **both) / 3
    for column, value in both.items():
        assert share("curved", **{column: value}) < 0.5
    a, b = spark.read.parquet(plain), spark.read.parquet(curved)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() == 40_000


def test_curve_of_few_and_missing_values(spark, big_day):
    few = big_day.limit(50).withColumn("region", F.lit(None).cast("string")).withColumn("product", F.lit("x"))
    assert splitters(few, "region") == [] and splitters(few, "product") == ["x"]
    assert along_curve(few, "order_date", ("region", "product"), "order_id").count() == 50
    assert along_curve(few.limit(0), "order_date", ("region", "product"), "order_id").collect() == []


# ---- a list of dates -------------------------------------------------------


def test_scan_dates_reads_listed_folders_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(8)]
    write_raw(raw_rows(spark, [(k, 1, "Widget A", 1, 2.0, 2.0, d, "North", "Online")
                               for k, d in enumerate(days * 3)]), path)
    wanted = spark.createDataFrame([(days[1],), (days[4],), (days[4],), (dt.date(2030, 1, 1),), (None,)], "d date")
    for d in (0, 2, 3, 5, 6, 7):       # a folder that is read fails the scan
        with open(f"{path}/order_date={days[d]}/broken.parquet", "wb") as f:
            f.write(b"not parquet")
    got = scan_dates(spark, path, wanted, ["order_id", "order_date"], schema=schemas.RAW_SALES_TABLE)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.order_date for r in got.collect())) == [days[1]] * 3 + [days[4]] * 3
    none = scan_dates(spark, path, wanted.limit(0), schema=schemas.RAW_SALES_TABLE)
    assert none.collect() == []


# ---- quarantine ------------------------------------------------------------

REC = {"order_id": 1, "customer_id": 5, "product": "Widget A", "quantity": 1, "price": 2.0,
       "total_amount": 2.0, "order_date": "2024-01-15", "region": "North", "channel": "Online"}


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_one_broken_line_of_a_thousand(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "t")
    lines = [json.dumps(REC | {"order_id": k}) for k in range(1000)]
    lines[500] = lines[500][:40]
    put(src, "a.json", lines[:700])
    put(src, "b.json", lines[700:])
    got = take_in(spark, src, path, schemas.RAW_SALES, max_rejects=1)
    assert (got.rows, got.rejects) == (999, 1)
    assert read_rows(spark, path, schemas.RAW_SALES).count() == 999
    reject = read_rejects(spark, path, schemas.RAW_SALES).first()
    assert reject.reject_reason == NOT_JSON and reject.reject_text == lines[500]
    assert reject.source_file.endswith("/a.json")


def test_reasons_limit_and_rerun(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "t")
    wrong = json.dumps(REC | {"quantity": "many"})
    keyless = json.dumps({k: v for k, v in REC.items() if k != "order_id"})
    put(src, "a.json", [json.dumps(REC), wrong, "[1, 2", keyless])
    with pytest.raises(TooManyRejects, match="3 of 4"):
        take_in(spark, src, path, schemas.RAW_SALES, required=("order_id",), max_rejects=2, batch="b1")
    assert read_rows(spark, path, schemas.RAW_SALES).count() == 0      # nothing committed
    assert read_rejects(spark, path, schemas.RAW_SALES).count() == 0
    for _ in range(2):                                                 # a rerun replaces the batch
        got = take_in(spark, src, path, schemas.RAW_SALES, required=("order_id",), max_rejects=3, batch="b1")
        assert (got.rows, got.rejects) == (1, 3)
    put(src, "a.json", [json.dumps(REC | {"order_id": 2})])
    take_in(spark, src, path, schemas.RAW_SALES, batch="b2")
    assert sorted(r.order_id for r in read_rows(spark, path, schemas.RAW_SALES).collect()) == [1, 2]
    found = {(r.reject_reason, r.reject_text) for r in read_rejects(spark, path, schemas.RAW_SALES).collect()}
    assert {w for w, _ in found} == {NOT_JSON, NOT_TYPED, "no order_id"} and (NOT_TYPED, wrong) in found
    assert json.loads(dict(found)["no order_id"])["product"] == "Widget A"


def test_csv_rejects(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "t")
    put(src, "a.csv", ["order_id,customer_id,product,quantity,price,order_date", '1,2,"a, b",3,4.5,2024-01-15',
                       "x,2,c,3,4.5,2024-01-15", "3,2,c,3,4.5,2024-01-15"])
    got = take_in(spark, src, path, schemas.CSV_SALES, fmt="csv")
    assert (got.rows, got.rejects) == (2, 1)
    reject = read_rejects(spark, path, schemas.CSV_SALES).first()
    assert (reject.reject_reason, reject.reject_text) == (NOT_CSV, "x,2,c,3,4.5,2024-01-15")


# ---- resumed runs ----------------------------------------------------------


def runs(spark, base):
    return {r.step: r.runs for r in read_ledger(spark, f"{base}/run_ledger").collect()}


def test_a_failed_run_is_taken_up_where_it_stopped(spark, tmp_path):
    raw = generate_sales(spark, RUN_DATE, 30, seed=3).withColumn("total_amount", F.col("total_amount") + 1)
    base = str(tmp_path / "wh")
    args = dict(spark=spark, raw=raw, base=base, as_of=RUN_DATE, summary_date=RUN_DATE, resume=True)
    assert run_daily(**args, exact=True).first().status == "error"          # the quality gate fails
    assert runs(spark, base) == {"land": 1, "raw": 1, "transform": 1, "stats": 1}
    ok = run_daily(**args, exact=True, gate_on=()).first()
    assert ok.status == "success" and ok.records_processed == 30
    assert runs(spark, base) == {"land": 1, "raw": 1, "transform": 1, "stats": 1, "quality": 1, "summary": 1}
    again = run_daily(**args, exact=True, gate_on=()).first()                # nothing left to do
    assert again == ok and set(runs(spark, base).values()) == {1}
    assert spark.read.parquet(f"{base}/transformed_sales").count() == 30


def test_new_input_and_lost_files_run_again(spark, tmp_path):
    base = str(tmp_path / "wh")
    raw = generate_sales(spark, RUN_DATE, 10, seed=4)
    args = dict(spark=spark, base=base, as_of=RUN_DATE, summary_date=RUN_DATE, resume=True, exact=False)
    run_daily(raw=raw, **args)
    more = raw.unionByName(raw.limit(1).withColumn("order_id", F.lit(9999).cast("long")))
    assert run_daily(raw=more, **args).first().records_processed == 11
    assert set(runs(spark, base).values()) == {2}
    day = f"{base}/transformed_sales/order_date={RUN_DATE}"
    os.remove(next(os.path.join(day, f) for f in sorted(os.listdir(day)) if f.endswith(".parquet")))
    assert run_daily(raw=more, **args).first().records_processed == 11
    assert runs(spark, base) == {"land": 2, "raw": 2, "transform": 3, "stats": 3, "quality": 3, "summary": 3}


def test_fingerprint_is_of_a_bag(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k long, v string")
    assert rows_fingerprint(a) == rows_fingerprint(a.orderBy(F.desc("k")).repartition(3))
    assert rows_fingerprint(a) != rows_fingerprint(a.distinct())
    assert rows_fingerprint(a.limit(0)) == "0:None:None"
