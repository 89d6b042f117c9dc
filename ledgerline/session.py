"""Session construction and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants. AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own conf."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
               .config("spark.ui.showConsoleProgress", "false"))
    if master.startswith("local"):
        builder = (builder.config("spark.driver.bindAddress", "127.0.0.1")
                   .config("spark.driver.host", "127.0.0.1"))
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Map tasks times reduce partitions is the number of shuffle blocks that the
# driver tracks; past some ten thousand partitions larger ones serve better.
MAX_SHUFFLE_PARTITIONS = 20_000


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths``, from a metadata listing
    (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def size_shuffle(spark: SparkSession, paths, target_bytes: int = TARGET_PARTITION_BYTES,
                 expansion: float = 3.0) -> int:
    """Size the shuffle for the input at ``paths`` and return the partition
    count.

    Sets ``spark.sql.shuffle.partitions`` to the input size times
    ``expansion`` (compressed columnar files grow when decoded into rows),
    divided by ``target_bytes``, between the cluster's default parallelism
    and ``MAX_SHUFFLE_PARTITIONS``. ``paths`` are the tables that are shuffled;
    ``expansion`` below 1 accounts for columns that are not read. The AQE advisory size and the scan split size are set to
    ``target_bytes``, so each reduce task holds about that much data and AQE
    merges the small partitions of selective queries.
    """
    size = input_bytes(spark, paths) * expansion
    n = max(spark.sparkContext.defaultParallelism, -(-int(size) // target_bytes))
    n = min(n, MAX_SHUFFLE_PARTITIONS)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    return n


def work_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job output.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster sets it.
    Only when it is unset (local tests) do we make one under the system
    temp folder and register it as the checkpoint dir.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the work dir, unique per call."""
    import uuid
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files that nothing refers to any more are removed when the
    driver's heap is collected, which may be long after they were last read.
    A job that goes on to other data calls this in between."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_shuffles(df: DataFrame) -> None:
    """Removes the shuffle files ``df`` comes from. Should it be used again,
    it is computed anew. For frames over an RDD, as micro-batches are: of
    others, this would run the adaptive plan."""
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
