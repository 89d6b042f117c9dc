"""The daily summary on a stream of arriving files (T1 + A2).

Spark's state store keeps, for each (date, customer), the partial sums of
all rows seen so far, behind a watermark on the order date. A micro-batch
gives the pairs it changed with their new totals. These are written into a
folder of that batch (a rerun of the batch replaces it), and the dates they
belong to are summed up again, a pair counting with its latest totals.

The state lies on the workers' disks, not in their heaps, and is stored by
its changes. Dates are summed up in slices, and each slice's shuffle files go
before the next one's come, so that the disk in use stays near the size of
the pairs.

What comes later than ``lateness`` behind the newest date seen is not
counted; whether that happened is returned, never hidden.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators.enrich import enrich
from ledgerline.operators.partials import finished, merged_columns, partial_columns, partial_names, with_limbs
from ledgerline.session import drop_shuffles, free_shuffles
from ledgerline.sinks.summary_state import write_version
from ledgerline.storage import Store
from ledgerline.streaming.ingest import MAX_FILE_AGE

PAIRS = T.StructType([T.StructField("summary_date", T.TimestampType()), T.StructField("customer_id", T.LongType()),
                      *[T.StructField(n, T.LongType()) for n in partial_names()],
                      T.StructField("batch", T.LongType())])

#: Rows of stored pairs whose dates are summed up in one go; some 50 bytes of
#: shuffle files each.
SLICE_ROWS = 4_000_000

_STORE = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.compression.codec": "zstd",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.compression": "zstd",
    # Room set aside ahead is some 4 MB a partition, however small its state.
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    # Counting the rows would cost a lookup each.
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    # Of all stores of an executor together.
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "400",
}


@dataclass(frozen=True)
class StreamRun:
    batches: int
    some_too_late: bool


def stream_summary(spark: SparkSession, source_dir: str, path: str, checkpoint: str, fmt: str = "json",
                   lateness: str = "90 days", max_files_per_trigger: int | None = None,
                   keep_invalid: bool = False, schema=schemas.RAW_SALES) -> StreamRun:
    """Takes in every file not seen yet and brings the summary under
    ``path`` up to date (``summary_state.read_summary`` reads it)."""
    reader = (spark.readStream.schema(schema).format(fmt)
              .option("mode", "FAILFAST").option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = enrich(reader.load(source_dir), keep_invalid=keep_invalid, stamp=False, with_sequence=False)
    pairs = (with_limbs(rows.withColumn("summary_date", F.col("order_date").cast("timestamp")))
             .withWatermark("summary_date", lateness)
             .groupBy("summary_date", "customer_id").agg(*partial_columns()))
    writer = (pairs.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .trigger(availableNow=True)
              .foreachBatch(lambda changed, batch: _upsert(changed, path, batch, spark)))
    with _settings(spark, STATE_CONF):
        query = writer.start()
    query.awaitTermination()
    progress = query.recentProgress
    dropped = sum(int(s.numRowsDroppedByWatermark) for p in progress for s in p.stateOperators)
    return StreamRun(len(progress), dropped > 0)


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """A stream keeps the session's settings as they are when it starts."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _upsert(changed: DataFrame, path: str, batch: int, session: SparkSession | None = None) -> None:
    """``session``: the one that started the stream; that of a micro-batch
    does not merge small shuffle partitions."""
    spark = session or changed.sparkSession
    folder = f"{path}/pairs/batch={batch}"
    # Each task sorts and writes the pairs of its own part of the state: the
    # state is gone through once, and what it gives is not shuffled again.
    (changed.sortWithinPartitions("summary_date", "customer_id")
     .write.mode("overwrite").option("compression", "zstd").parquet(folder))
    drop_shuffles(changed)
    # As many dates as the files of the batch have days.
    found = spark.read.schema(PAIRS).parquet(folder).select(F.col("summary_date").cast("date")).distinct().collect()
    touched = sorted(r[0] for r in found if r[0] is not None)
    if not touched:
        return
    slices = _slices(spark, path, batch, touched)
    if len(slices) == 1:
        write_version(finished(_sums(spark, path, batch, touched)), path, batch)
        free_shuffles(spark)
        return
    parts = [f"{path}/sums/batch={batch}/slice={n}" for n in range(len(slices))]
    for days, part in zip(slices, parts, strict=True):
        _sums(spark, path, batch, days).coalesce(1).write.mode("overwrite").parquet(part)
        free_shuffles(spark)
    write_version(finished(spark.read.parquet(*parts)), path, batch)
    Store(spark).delete(f"{path}/sums/batch={batch}")


def _pairs(spark: SparkSession, path: str, batch: int, days: list[dt.date]) -> DataFrame:
    """What is stored, up to this batch, from the first to the last of these
    days. A later batch's totals hold; of this batch's rerun, no later ones
    exist."""
    since, until = F.lit(days[0]).cast("timestamp"), F.date_add(F.lit(days[-1]), 1).cast("timestamp")
    return (spark.read.schema(PAIRS).parquet(f"{path}/pairs")
            .where((F.col("summary_date") >= since) & (F.col("summary_date") < until) & (F.col("batch") <= batch))
            .withColumn("_day", F.col("summary_date").cast("date")))


def _slices(spark: SparkSession, path: str, batch: int, touched: list[dt.date]) -> list[list[dt.date]]:
    """The days, in order, in runs of some ``SLICE_ROWS`` pairs; a day with
    more is a run of its own."""
    rows = dict(map(tuple, _pairs(spark, path, batch, touched).groupBy("_day").count().collect()))
    out, held = [[]], 0
    for day in touched:
        if out[-1] and held + rows[day] > SLICE_ROWS:
            out.append([])
            held = 0
        out[-1].append(day)
        held += rows[day]
    return out


def _sums(spark: SparkSession, path: str, batch: int, days: list[dt.date]) -> DataFrame:
    """Partial sums, one row a date, of the dates from the first to the last
    of these days that the batch has touched."""
    pairs, names = _pairs(spark, path, batch, days), partial_names()
    touched = pairs.where(F.col("batch") == batch).select("_day").distinct()
    latest = (pairs.join(F.broadcast(touched), "_day", "left_semi")
              .groupBy("summary_date", "customer_id").agg(F.max_by(F.struct(*names), "batch").alias("now"))
              .select(F.col("summary_date").cast("date").alias("summary_date"), "customer_id", "now.*"))
    return latest.groupBy("summary_date").agg(
        *merged_columns(), F.count("customer_id").alias("unique_customers"))
