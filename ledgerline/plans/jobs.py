"""Composite jobs (C1-C3): plain functions over the operators and sinks.

Scheduling, retries and notifications are left to whatever runs these
functions; each job returns a DataFrame the caller can act on.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.calendar import to_date_value
from ledgerline.operators.enrich import RAW_COLUMNS, derive_sales, enrich, fill_nulls
from ledgerline.operators.quality import (
    DEFAULT_GATE_ON, QualityGateError, gates, quality_gate, quality_profile, raise_on_failed,
)
from ledgerline.operators.reports import daily_summary, load_stats, run_report, sales_report
from ledgerline.operators.users import flatten_users, stamp_created
from ledgerline.plans.ledger import RunLedger, files_fingerprint, rows_fingerprint
from ledgerline.sinks.files import (
    append_by_key, backup, land_raw, partition_dates, write_csv, write_raw, write_report, write_summary,
    write_transformed,
)
from ledgerline.sources.files import read_raw_json, read_sales_csv, read_user_docs
from ledgerline.sources.tables import scan_sales

# Fixed value: the message the original returns.
SUCCESS_MESSAGE = "Data transformation completed successfully"


def _status(spark: SparkSession, status: str, date: str, records=None, revenue=None,
            message=None, error=None, checks=None) -> DataFrame:
    """The one-row run status record."""
    return spark.createDataFrame([(status, date, records, revenue, message, error,
                                   json.dumps(checks) if checks else None)],
                                 schemas.RUN_STATUS)


def run_daily(spark: SparkSession, raw: DataFrame, base: str, as_of=None, exact: bool = True,
              gate_on=DEFAULT_GATE_ON, mode: str = "dynamic",
              summary_date=None, resume: bool = False) -> DataFrame:
    """Land -> raw table -> enrich -> stats -> quality gate -> summary.

    ``raw`` is any frame with the raw columns; only ``as_of``'s rows are
    processed. Every table is partitioned by date and rewritten per date,
    so rerunning a day gives the same tables. The summary is that of
    ``summary_date``, by default the day before ``as_of`` as in the original
    query. Any failure becomes an ``error`` status row with the message, as
    the original returned it; ``quality_checks`` holds the profile as JSON.

    With ``resume``, completed steps are recorded under ``base/run_ledger``,
    and steps whose input and files have not changed since are not run again:
    a run that failed is taken up at the step that failed.
    """
    # No date means today's run; "2024-01-15T06:00:00" keeps the date part.
    day = to_date_value(as_of) if as_of is not None else _dt.date.today()
    date_text = day.isoformat()
    base = base.rstrip("/")
    landed, stored, made = f"{base}/raw-sales-data", f"{base}/raw_sales", f"{base}/transformed_sales"
    step = RunLedger(spark, f"{base}/run_ledger", date_text).step if resume else (
        lambda name, given, run, left=None: run())
    files = (lambda *folders: files_fingerprint(spark, *folders)) if resume else (lambda *folders: "")
    try:
        rows = raw.filter(F.col("order_date") == F.lit(day)).select(*RAW_COLUMNS)
        of_day = [f"{landed}/{date_text}", f"{stored}/order_date={date_text}", f"{made}/order_date={date_text}"]
        step("land", rows_fingerprint(rows) if resume else "", lambda: land_raw(rows, landed, day),
             lambda: files(of_day[0]))
        step("raw", files(of_day[0]), lambda: write_raw(
            read_raw_json(spark, of_day[0]), stored, dates=[day]), lambda: files(of_day[1]))
        raw_day = scan_sales(spark, stored, day, day, columns=list(RAW_COLUMNS), schema=schemas.RAW_SALES_TABLE)
        step("transform", f"{mode} {files(of_day[1])}", lambda: write_transformed(
            enrich(raw_day, day, day), made, mode=mode, dates=[day]), lambda: files(of_day[2]))
        transformed = scan_sales(spark, made, day, day, schema=schemas.TRANSFORMED_SALES)
        done = files(of_day[2])
        stats = step("stats", done, lambda: load_stats(transformed, day).first().asDict())
        checks = step("quality", f"{exact} {sorted(gate_on)} {done}", lambda: quality_gate(
            quality_profile(transformed, day), exact=exact, gate_on=gate_on))
        sday = to_date_value(summary_date) if summary_date is not None else day - _dt.timedelta(days=1)
        # A date that the table does not hold (the first run, or mode
        # "replace") was not computed here: its stored summary stays.
        if sday == day or sday in partition_dates(spark, made, "order_date"):
            summary_src = scan_sales(spark, made, sday, sday, schema=schemas.TRANSFORMED_SALES)
            step("summary", files(f"{made}/order_date={sday.isoformat()}"),
                 lambda: write_summary(daily_summary(summary_src, sday, sday), f"{base}/daily_summary", dates=[sday]),
                 lambda: files(f"{base}/daily_summary/summary_date={sday.isoformat()}"))
        return _status(spark, "success", date_text, int(stats["row_count"]),
                       float(stats["total_revenue"]), SUCCESS_MESSAGE, None, checks)
    except Exception as exc:  # noqa: BLE001 - the job reports, the caller decides
        return _status(spark, "error", date_text, None, None, None, str(exc).split("\n")[0])


def run_csv_report(spark: SparkSession, csv_path: str, out_dir: str, run_date=None) -> DataFrame:
    """Extract (CSV) -> transform -> validate -> report (+ backup).

    With ``run_date`` the report is one row over the whole file, stamped with
    that date, whatever dates the rows hold; without it, one row per date.
    The transformed frame feeds the validation, the report and the backup,
    so it is written once and read back rather than recomputed.
    """
    out_dir = out_dir.rstrip("/")
    raw = read_sales_csv(spark, csv_path)
    derived = derive_sales(raw)
    check = gates(derived).filter(F.col("gate") == "nonzero_revenue")
    raise_on_failed(check)
    transformed = fill_nulls(derived)
    transformed.write.mode("overwrite").parquet(f"{out_dir}/transformed")
    stored = spark.read.parquet(f"{out_dir}/transformed")
    write_csv(stored, f"{out_dir}/transformed_csv")
    raise_on_failed(gates(stored).filter(F.col("gate").isin("has_rows", "non_negative_revenue")))
    report = sales_report(stored) if run_date is None else run_report(stored, run_date)
    write_report(report, f"{out_dir}/sales_report")
    backup(spark, f"{out_dir}/transformed", out_dir, run_date or _dt.date.today())
    return spark.read.schema(report.schema).json(f"{out_dir}/sales_report")


def run_users(spark: SparkSession, docs_path: str, table_path: str, created_at=None,
              multiline: bool = True) -> DataFrame:
    """Read documents -> flatten -> stamp -> append new keys."""
    docs = read_user_docs(spark, docs_path, multiline=multiline)
    flat = stamp_created(flatten_users(docs, text_col=None), created_at, as_text=False)
    return append_by_key(flat, table_path, key="id")


def processed_message(report: DataFrame) -> DataFrame:
    """The extract step's one-line text over a report's rows."""
    return report.select(F.format_string(
        "Processed %d records, total revenue: $%.2f", F.sum("total_orders"),
        F.sum("total_revenue")).alias("message"))


__all__ = ["processed_message", "run_daily", "run_csv_report", "run_users", "QualityGateError"]
