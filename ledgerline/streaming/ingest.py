"""Incremental ingest of arriving sales files, each file exactly once.

The file source remembers which files it has read in the checkpoint, and
the file sink commits each micro-batch atomically in its own log, so a
rerun after a crash neither skips nor repeats a file. ``availableNow``
processes whatever has arrived and stops, which replaces the poll-and-wait
file sensor with a job that can run on any schedule.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.storage import Store
from ledgerline.streaming.commit_log import committed_files, stored_rows

#: The source skips files older than this, measured from the newest file it
#: has seen. Far beyond any file's age, so that a late file with an old
#: modification time (restored, copied with its times) is read too; the price
#: is that the source's list of seen files keeps every name.
MAX_FILE_AGE = "36500d"


def ingest_new_files(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                     fmt: str = "json", schema=schemas.RAW_SALES,
                     max_files_per_trigger: int | None = None,
                     writers: int | None = None, date_col: str = "order_date",
                     run_id: str | None = None) -> int:
    """Append every not-yet-seen file under ``source_dir`` to the parquet
    table at ``target`` (partitioned by ``date_col``, stamped created_at).
    Returns the number of rows this run added. A record that does not parse
    fails the run before its micro-batch is committed.

    The number is that of the rows in the files which the sink's commit log
    gained since the run began. A run with a ``run_id`` keeps a record of
    where it began beside the checkpoint: called again after a crash, at
    whatever point, it goes on and returns the count of the whole run, and
    called again after it has returned, it returns the same count.

    Each micro-batch is rebalanced on the date (a streaming frame cannot be
    sorted). A date lands in one bucket, so it becomes one file instead of
    one per input file that holds it. AQE, which runs inside the
    micro-batches of a stateless query, cuts a bucket holding a third of the
    rows into several tasks and merges small ones. Unlike a range repartition
    there is no sampling job, which would read and parse every micro-batch
    twice. ``writers`` sets the bucket count (default
    ``spark.sql.shuffle.partitions``).
    """
    store = Store(spark)
    record = f"{checkpoint.rstrip('/')}-runs/{run_id}.json" if run_id else None
    run = json.loads((record and store.read_text(record)) or "null")
    if run is None:
        run = {"files_before": len(committed_files(spark, target))}
        if record:
            store.write_text(record, json.dumps(run))
    if "rows" in run:
        return run["rows"]
    reader = (spark.readStream.schema(schema).format(fmt)
              .option("mode", "FAILFAST").option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    n = writers or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = (reader.load(source_dir).withColumn("created_at", F.current_timestamp())
              .hint("rebalance", n, date_col))
    stream.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", checkpoint).partitionBy(date_col).outputMode("append").trigger(
        availableNow=True).start().awaitTermination()
    run["rows"] = stored_rows(spark, committed_files(spark, target)[run["files_before"]:])
    if record:
        store.write_text(record, json.dumps(run))
    return run["rows"]
