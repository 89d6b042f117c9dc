"""Skew check: one key holds a third of the rows.

Runs each keyed operator next to its plain window form on the same frame,
with Spark's event log in a scratch folder, then reports, per job group,
the largest number of shuffle records any single task read. With a plain
window the hot key's rows all land in one task; the library's forms
combine them before the shuffle, so no task reads more than a share.

    python tools/skew_check.py [rows] [one-day] [--ops rank,latest,dedupe]

Operator pairs:
  rank    RANK() OVER (PARTITION BY customer ORDER BY date)  vs  order_sequence
  latest  ROW_NUMBER() = 1 per user by ts desc               vs  latest_snapshot
  dedupe  ROW_NUMBER() = 1 per id                            vs  dedupe_by_key

``one-day`` puts all the hot customer's rows on a single date, so the
rank's join-back key (customer, date) itself is hot; AQE's skew join then
has to split it.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.operators.enrich import order_sequence  # noqa: E402
from ledgerline.operators.users import dedupe_by_key, latest_snapshot  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _hot_rows(spark, n: int, one_day: bool):
    """Every third row belongs to key 0; the rest spread over 100k keys."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id"),
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 100_000 + 1).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"),
                   F.when(F.lit(one_day) & hot, F.lit(0))
                   .otherwise(F.col("id") % 365).cast("int")).alias("order_date"))


def run_rank(sc, rows) -> None:
    sc.setJobGroup("rank-plain", "plain window")
    w = Window.partitionBy("customer_id").orderBy("order_date")
    _noop(rows.select("id", F.rank().over(w).alias("r")))
    sc.setJobGroup("rank-safe", "order_sequence")
    _noop(order_sequence(rows))


def run_latest(sc, rows) -> None:
    snaps = rows.select(F.col("customer_id").alias("user_id"),
                        F.timestamp_seconds(F.col("id")).alias("snapshot_ts"),
                        F.col("id").alias("snapshot_id"),
                        F.sha1(F.col("id").cast("string")).alias("doc"))
    sc.setJobGroup("latest-plain", "row_number window")
    w = Window.partitionBy("user_id").orderBy(F.col("snapshot_ts").desc(), F.col("snapshot_id").desc())
    _noop(snaps.withColumn("_r", F.row_number().over(w)).filter("_r = 1"))
    sc.setJobGroup("latest-safe", "latest_snapshot")
    _noop(latest_snapshot(snaps, None))


def run_dedupe(sc, rows) -> None:
    batch = rows.select(F.col("customer_id").alias("key"),
                        F.sha1(F.col("id").cast("string")).alias("name"))
    sc.setJobGroup("dedupe-plain", "row_number window")
    w = Window.partitionBy("key").orderBy("name")
    _noop(batch.withColumn("_r", F.row_number().over(w)).filter("_r = 1"))
    sc.setJobGroup("dedupe-safe", "dedupe_by_key")
    _noop(dedupe_by_key(batch, "key"))


OPS = {"rank": run_rank, "latest": run_latest, "dedupe": run_dedupe}


def max_task_records(logdir: str) -> dict:
    """(job group, stage id) -> largest shuffle records read by one task."""
    stage_group, best = {}, {}
    for path in glob.glob(f"{logdir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    key = (stage_group.get(ev["Stage ID"]), ev["Stage ID"])
                    best[key] = max(best.get(key, 0), recs)
    return best


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--ops")]
    ops_arg = next((a.split("=", 1)[1] for a in sys.argv[1:] if a.startswith("--ops=")), "rank")
    n = int(args[0]) if args else 3_000_000
    one_day = len(args) > 1 and args[1] == "one-day"
    logdir = tempfile.mkdtemp(prefix="skewlog-")
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false",
        # keep AQE from folding the small test partitions into one
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        # AQE cuts a skewed partition into pieces of at least the advisory
        # size (64 MB by default); scale it down with the test data, or a
        # 30 MB hot partition stays one piece
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        # a hot key's rows compress well, so its partition is only ~5x the
        # median in bytes here (8x in records); at scale a third of the data
        # exceeds any factor
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": os.environ.get("FORCE_SKEW", "false"),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    rows = _hot_rows(spark, n, one_day)
    for op in ops_arg.split(","):
        OPS[op](spark.sparkContext, rows)
    spark.stop()
    jobs = {}
    for (group, sid), recs in sorted(max_task_records(logdir).items(),
                                     key=lambda kv: (str(kv[0][0]), kv[0][1])):
        if recs:
            jobs.setdefault(group, []).append(recs)
            print(f"{group:13s} stage {sid:3d}: largest task read {recs:>10,d} shuffle records")
    print(json.dumps({"rows": n, "hot_rows": (n + 2) // 3,
                      "max_task_records": {g: max(v) for g, v in jobs.items()}}))


if __name__ == "__main__":
    main()
