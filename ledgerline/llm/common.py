"""Helpers shared by the operators: tables, lineage cuts, files in tasks."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space as the characters themselves.
SPACES = " \t\n\x0b\x0c\r"
#: Rows of one Arrow batch; with documents of up to a few hundred KB a
#: batch stays within some tens of MB of a Python worker.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches of the Python stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: the lineage
    is cut, a lost executor costs no recomputation, and column pruning
    works on what follows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(file system, path) for a shared folder; works in tasks and on the
    driver, for local mounts and for the stores pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def worker_state() -> dict:
    """A dict that lives as long as the Python worker process, for caches
    that several tasks of one worker share."""
    return sys.modules.setdefault(
        "_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


def id_hash_mod(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo ``n`` (null ids: as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


class Kept:
    """Packed ids by word or chunk, in two generations: when the young one is
    full it becomes the old one, and what is asked for again moves back.
    Frequent ones so stay, and the number kept is bounded."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def age(self, size: int) -> None:
        if len(self.young) > size:
            self.young, self.old = {}, self.young

    def look_up(self, keys: list[str], learn) -> list[bytes]:
        """The ids of all keys; ``learn`` puts unknown ones into ``young``."""
        young, old = self.young, self.old
        packed = list(map(young.get, keys))
        new = []
        for k in [k for k, found in enumerate(packed) if found is None]:
            found = old.get(keys[k])
            if found is None:
                new.append(k)
            else:
                young[keys[k]] = packed[k] = found
        if new:
            learn(list(dict.fromkeys(keys[k] for k in new)))
            for k in new:
                packed[k] = young[keys[k]]
        return packed
