"""Bloom filters of the keys of each batch folder of a keyed table.

A batch's filter is a small table beside its folder: blocks of 2^15 bits, a
power of two of them, sized for ``BITS_PER_KEY``. A key belongs to one block
and sets ``PROBES`` bits there, so filters are built and asked with built-in
expressions, one row per block, and a filter of any size is many rows. New
keys are asked once for every size of filter there is (at most some forty),
and meet the blocks of all folders of that size by an equi-join.

A folder without a filter, as after a crash before it was written, counts as
one that may hold any key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.storage import Store

BLOCK_BITS = 1 << 15
BITS_PER_KEY = 12
PROBES = 6
FILTER_SCHEMA = "block long, bits binary, blocks long, batch string"


def blocks_for(keys: int) -> int:
    return 1 << max(0, (keys * BITS_PER_KEY - 1) // BLOCK_BITS).bit_length()


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), blocks)


def _positions(key: Column) -> Column:
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)).cast("int")
                                      for k in range(PROBES)]))


def write_filter(rows: DataFrame, key: str, n_rows: int, path: str) -> None:
    """The filter of ``rows`` (a batch that is stored already)."""
    blocks = F.lit(blocks_for(n_rows)).cast("long")
    bits = rows.select(_block(F.col(key), blocks).alias("block"), F.explode(_positions(F.col(key))).alias("at"))
    # The bitmap's own numbering: bit p of byte p / 8.
    (bits.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
     .withColumn("blocks", blocks).sortWithinPartitions("block").write.mode("overwrite").parquet(path))


def _has(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, at % 8) == 1


def folders_to_read(spark: SparkSession, data: str, filters: str, keys: DataFrame, key: str) -> list[str]:
    """Names of the folders under ``data`` that may hold one of ``keys``."""
    store = Store(spark)
    folders = [n for n in store.names(data) if n.startswith("batch=")]
    known = set(folders) & set(store.names(filters))
    if not known:
        return folders
    stored = spark.read.schema(FILTER_SCHEMA).parquet(filters)
    sizes = [r["blocks"] for r in stored.select("blocks").distinct().collect()]
    asked = (keys.select(F.col(key).alias("_key"), F.explode(F.lit(sizes)).alias("blocks"))
             .select("blocks", _block(F.col("_key"), F.col("blocks")).alias("block"),
                     _positions(F.col("_key")).alias("at")))
    hits = (stored.join(asked, ["blocks", "block"])
            .where(F.forall("at", lambda p: _has(F.col("bits"), p))).select("batch").distinct())
    found = {f"batch={r['batch']}" for r in hits.collect()}
    return [f for f in folders if f not in known or f in found]
