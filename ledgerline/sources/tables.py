"""Scans of the date-partitioned sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import as_date
from ledgerline.operators.joins import broadcast_if_small


def date_range_filter(df: DataFrame, start=None, end=None, col: str = "order_date") -> DataFrame:
    """Inclusive [start, end] on the bare date column, so parquet partition
    pruning and row-group statistics both apply."""
    if start is not None:
        df = df.filter(F.col(col) >= as_date(start))
    if end is not None:
        df = df.filter(F.col(col) <= as_date(end))
    return df


def scan_sales(spark: SparkSession, path: str, start=None, end=None,
               columns: list[str] | None = None, date_col: str = "order_date",
               schema=None) -> DataFrame:
    """Read a table written with ``partitionBy(date_col)``; one date when
    start == end, a backfill range otherwise. With ``schema`` the read needs
    no footer inference, and a table with no partitions yet reads as empty."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    df = date_range_filter(df, start, end, date_col)
    return df.select(*columns) if columns else df


#: Dates of a list that a scan is told at once; a century has 36,525 days.
MAX_DATES = 100_000


def scan_dates(spark: SparkSession, path: str, dates: DataFrame, columns: list[str] | None = None,
               date_col: str = "order_date", schema=None) -> DataFrame:
    """S3 for any list of dates: the rows of a table written with
    ``partitionBy(date_col)`` whose date is in the first column of ``dates``.

    The list is joined to the partition column, and Spark's dynamic partition
    pruning hands the dates it finds to the scan, which lists and reads their
    folders only. Pruning is planned for a broadcast list that has a filter;
    ``broadcast_if_small`` checks the size, and a longer list is joined
    without pruning.
    """
    wanted = dates.select(F.col(dates.columns[0]).cast("date").alias(date_col)).distinct()
    wanted = wanted.where(F.col(date_col) >= F.lit("0001-01-01").cast("date"))
    table = scan_sales(spark, path, columns=None, date_col=date_col, schema=schema)
    out = table.join(broadcast_if_small(wanted, MAX_DATES), date_col, "left_semi").select(*table.columns)
    return out.select(*columns) if columns else out
