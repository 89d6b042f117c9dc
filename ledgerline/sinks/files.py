"""Parquet / CSV / JSON sinks.

Partitioned tables use dynamic partition overwrite: a rerun for a date
replaces that date's folder and leaves the others, so reruns are
idempotent (the append load of the original doubled rows). Writes go
through Spark's commit protocol: a task lost mid-write is retried and only
committed task output becomes visible.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import to_date_value
from ledgerline.operators.users import dedupe_by_key, require_key, to_user_rows
from ledgerline.session import scratch_path
from ledgerline.sinks.clustering import along_curve
from ledgerline.sinks.key_filters import folders_to_read, write_filter
from ledgerline.sources.files import CSV_QUOTES
from ledgerline.storage import Store

DEFAULT_CLUSTER = ("region", "product")
#: Distinct keys of a batch up to which the stored folders' filters are asked.
PRUNE_KEYS = 1_000_000
#: Where they lie: a folder beside the table's.
FILTERS = "-key-filters"
# Fixed value: the folder name Spark gives a NULL partition value.
NO_DATE = "=__HIVE_DEFAULT_PARTITION__"


def _layout(df: DataFrame, partition_col: str, cluster_by=(), tiebreak: str | None = None) -> DataFrame:
    """Shuffle the rows so each date is written by as few tasks as its size
    needs, then sort inside each task on (date, cluster columns, tiebreak)
    for tight parquet min/max statistics on the cluster columns.

    ``REBALANCE`` hash-partitions on the date, and AQE then splits a bucket
    above the advisory size into several tasks (a date with a third of the
    rows becomes many files of about that size) and merges small buckets, so
    a quiet date is one file. Unlike a range repartition it needs no
    sampling job, which computes the stage feeding the shuffle a second time
    (for a JSON landing, the whole parse). The split needs AQE, which the
    library's sessions enable."""
    order = [partition_col, *cluster_by] + ([tiebreak] if tiebreak else [])
    return df.hint("rebalance", partition_col).sortWithinPartitions(*order)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: CSV with a header row. Fields with quotes, commas or line breaks
    are quoted, quotes doubled; white space at a field's ends stays."""
    df.write.mode(mode).options(header=True, ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False, **CSV_QUOTES).csv(path)


def land_raw(df: DataFrame, base: str, date) -> str:
    """K2: the day's raw records as NDJSON under ``base/<date>``."""
    path = f"{base.rstrip('/')}/{to_date_value(date).isoformat()}"
    df.write.mode("overwrite").json(path)
    return path


def write_raw(df: DataFrame, path: str, append: bool = False,
              cluster_by=DEFAULT_CLUSTER, dates=None) -> None:
    """K3: raw table partitioned by order_date with a created_at stamp.
    ``append=True`` reproduces the original (rerun doubles a date). With
    ``dates``, those dates are replaced even when the new data has no rows
    for them."""
    out = df.withColumn("created_at", F.current_timestamp())
    out = _layout(out, "order_date", cluster_by, "order_id")
    w = (out.write.mode("append" if append else "overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("order_date"))
    _overwrite_dates(df.sparkSession, path, "order_date", None if append else dates,
                     lambda: w.parquet(path))


def write_transformed(df: DataFrame, path: str, mode: str = "dynamic",
                      cluster_by=DEFAULT_CLUSTER, dates=None, curve: bool = False,
                      files: int | None = None) -> None:
    """K4: transformed table. ``dynamic`` replaces only the dates present;
    ``replace`` drops the whole table first (the original keeps one day).
    ``curve`` lays the rows of large dates out along a Z-order curve through
    ``cluster_by`` (see ``along_curve``, also for ``files``), so that filters
    on either column skip files; ``df`` is written to the work folder first,
    since it is gone through several times."""
    spark, held = df.sparkSession, None
    if curve:
        held = scratch_path(spark, "curve")
        df.write.parquet(held)
        df = spark.read.schema(df.schema).parquet(held)
    out = (along_curve(df, "order_date", cluster_by, "order_id", files) if curve
           else _layout(df, "order_date", cluster_by, "order_id"))
    w = out.write.mode("overwrite").partitionBy("order_date")
    w = w.option("partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
    _overwrite_dates(spark, path, "order_date", None if mode == "replace" else dates,
                     lambda: w.parquet(path))
    if held:
        Store(spark).delete(held)


def write_summary(df: DataFrame, path: str, dates=None, append: bool = False) -> None:
    """K5/K6: daily summary partitioned by summary_date.

    Delete-then-insert for the given ``dates``: dynamic overwrite replaces
    every date present in ``df``; dates asked for but absent from ``df``
    (an empty rerun) are dropped explicitly, since an empty dynamic
    overwrite would leave the old partition in place.
    """
    out = df.withColumn("processing_timestamp", F.current_timestamp()) \
        if "processing_timestamp" not in df.columns else df
    # One summary row per date, so no date is hot. Range-partition the dates
    # over a fixed number of writer tasks: a hash repartition on the grouping
    # key would be dropped as redundant after the aggregate, and AQE would
    # then fold the tiny aggregate into one task writing every folder in turn.
    writers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = (out.repartitionByRange(writers, "summary_date").write
         .mode("append" if append else "overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("summary_date"))
    _overwrite_dates(df.sparkSession, path, "summary_date", None if append else dates,
                     lambda: w.parquet(path))


def write_report(df: DataFrame, path: str) -> None:
    """K7: the report rows as JSON in one file. The report has one row per
    date, so one writer task is bounded. ``repartition(1)`` rather than
    ``coalesce(1)``: the shuffle boundary keeps the aggregates and the join
    above it parallel, where a coalesce would pull them into the one task."""
    df.repartition(1).write.mode("overwrite").json(path)


def append_by_key(batch: DataFrame, path: str, key: str = "id", created_at=None,
                  prune_keys: int = PRUNE_KEYS) -> DataFrame:
    """K8 + J1: create-if-absent and append users whose key is new.

    Each batch is written once, into a folder of its own, and the appended
    rows are read back from there, so the caller's count is the committed
    one. One writer at a time: parquet has no key constraint to stop two
    concurrent appends of the same key.

    For each folder a Bloom filter of its keys is kept beside the table. A batch of up to
    ``prune_keys`` distinct keys asks the filters which folders may hold one
    of them and compares with those folders' keys only; a larger one, which
    would hit them all, compares with every stored key. Either way the
    anti-join decides, on the keys themselves.
    """
    from ledgerline.operators.users import stamp_created
    spark = batch.sparkSession
    rows = to_user_rows(stamp_created(batch, created_at, as_text=False)
                        if "created_at" not in batch.columns else batch)
    incoming = scratch_path(spark, "incoming")
    dedupe_by_key(require_key(rows, key), key).select(*rows.columns).write.parquet(incoming)
    fresh = spark.read.schema(rows.schema).parquet(incoming)
    data, filters = f"{path.rstrip('/')}/data", path.rstrip("/") + FILTERS
    existing = _read_or_none(spark, path)
    if existing is not None and fresh.count() <= prune_keys:
        folders = folders_to_read(spark, data, filters, fresh, key)
        existing = _read_folders(spark, [f"{data}/{f}" for f in folders]) if folders else None
    if existing is not None:
        fresh = fresh.join(existing.select(key), key, "left_anti").select(*rows.columns)
    name = f"batch={uuid.uuid4().hex}"
    fresh.write.parquet(f"{data}/{name}")
    appended = spark.read.schema(fresh.schema).parquet(f"{data}/{name}")
    write_filter(appended, key, appended.count(), f"{filters}/{name}")
    return appended


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """The stored users; empty if nothing was stored yet."""
    from ledgerline import schemas
    stored = _read_or_none(spark, path)
    return stored if stored is not None else spark.createDataFrame([], schemas.USERS)


def _read_or_none(spark: SparkSession, path: str):
    """The stored users, or None when nothing was stored yet. Only a missing
    folder counts as empty; any other read error propagates, so a table that
    cannot be read is never mistaken for an empty one (that would re-append
    every key)."""
    from ledgerline import schemas
    data = path.rstrip("/") + "/data"
    fs, p, _ = _fs(spark, data)
    if not fs.exists(p):
        return None
    return _read_folders(spark, [data])


def _read_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    from ledgerline import schemas
    return spark.read.schema(schemas.USERS).parquet(*folders).select(*schemas.USERS.names)


def truncate_table(spark: SparkSession, path: str, schema) -> None:
    """K9: the table stays and has no rows. A keyed table (``append_by_key``)
    loses its batch folders (and their filters, afterwards: a filter without
    a folder is not asked); any other is overwritten with an empty frame."""
    fs, data, jvm = _fs(spark, path.rstrip("/") + "/data")
    if fs.exists(data):
        fs.delete(data, True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + FILTERS), True)
    else:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def backup(spark: SparkSession, src: str, base: str, date=None, schema=None,
           partition_col: str | None = None, cluster_by=DEFAULT_CLUSTER) -> str:
    """Dated copy ``backup_yyyyMMdd`` of a parquet table. With
    ``partition_col`` the copy is laid out and partitioned like the table;
    ``schema`` spares the inference of its column types."""
    d = to_date_value(date) if date is not None else _dt.date.today()
    dest = f"{base.rstrip('/')}/backup_{d:%Y%m%d}"
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(src)
    if partition_col:
        rows = _layout(rows, partition_col, cluster_by, "order_id")
        rows.write.mode("overwrite").partitionBy(partition_col).parquet(dest)
    else:
        rows.write.mode("overwrite").parquet(dest)
    return dest


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def partition_dates(spark: SparkSession, path: str, col: str) -> list[_dt.date]:
    """Dates of the ``col=yyyy-MM-dd`` folders (a metadata listing). The
    folder of rows without a date is not among them."""
    fs, root, _ = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "=") and not name.endswith(NO_DATE):
            out.append(_dt.date.fromisoformat(name.split("=", 1)[1]))
    return sorted(out)


def _delete_partitions(spark: SparkSession, path: str, col: str, dates) -> int:
    fs, root, jvm = _fs(spark, path)
    n = 0
    for d in dates:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{col}={to_date_value(d).isoformat()}")
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def _listing(spark: SparkSession, path: str, col: str, dates) -> dict:
    """File names in each requested date folder that exists (metadata only)."""
    fs, root, jvm = _fs(spark, path)
    out = {}
    for d in dates:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{col}={to_date_value(d).isoformat()}")
        if fs.exists(p):
            out[to_date_value(d)] = frozenset(st.getPath().getName() for st in fs.listStatus(p))
    return out


def _overwrite_dates(spark: SparkSession, path: str, col: str, dates, write) -> None:
    """Run ``write`` (a dynamic partition overwrite) so that every requested
    date ends up holding exactly what the write produced for it.

    Dynamic overwrite replaces each folder the write produced, under new file
    names (every job's files carry a fresh id), and leaves the others alone.
    A requested folder whose file names did not change was therefore not
    written this time: its date had no rows, and its old folder is dropped.
    The check lists one folder per requested date and never computes the
    input again.
    """
    if not dates:
        write()
        return
    before = _listing(spark, path, col, dates)
    write()
    after = _listing(spark, path, col, list(before))
    stale = [d for d, names in before.items() if after.get(d) == names]
    if stale:
        _delete_partitions(spark, path, col, stale)


def expire(spark: SparkSession, path: str, as_of, days: int, col: str = "order_date") -> int:
    """Drop partitions older than ``as_of - days`` (kept: col >= as_of -
    days). Deletes whole partition folders; no data is rewritten. Rows
    without a date have no age and stay."""
    cutoff = to_date_value(as_of) - _dt.timedelta(days=days)
    old = [d for d in partition_dates(spark, path, col) if d < cutoff]
    return _delete_partitions(spark, path, col, old)
