"""RANK over very large and skewed partitions in one pass of the input.

Rows are range-partitioned on (key, order, a hash of the row), so a key of
any size, and a (key, order) pair of any size, is spread over as many tasks
as its rows need. Each task counts along its sorted rows, and its last row
says how its partition begins and ends; a running total over these lines,
one a partition, gives what the first key of each partition has had before
it. Nothing is joined back, and the input is evaluated once: the counted
rows are written, and the running totals are added when they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.session import scratch_path


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; null equals null."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return ~same.to_numpy(zero_copy_only=False)


def rank_in_ranges(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """``df`` with ``name`` = RANK() OVER (PARTITION BY key ORDER BY order),
    null orders first, null keys a partition of their own. The counted rows
    are written under the work folder when this is called."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranks")
    ranged = (df.withColumn("_spread", F.xxhash64(*[F.col(c) for c in df.columns]))
              .repartitionByRange(key, order, "_spread").sortWithinPartitions(key, order).drop("_spread"))
    key_field, order_field = df.schema[key], df.schema[order]
    border = T.StructType([
        T.StructField("key", key_field.dataType), T.StructField("order", order_field.dataType),
        T.StructField("first_rows", T.LongType()), T.StructField("first_peers", T.LongType()),
        T.StructField("last_key", key_field.dataType), T.StructField("last_order", order_field.dataType),
        T.StructField("last_rows", T.LongType()), T.StructField("last_peers", T.LongType())])
    counted = T.StructType([*df.schema.fields, T.StructField("_before", T.LongType()),
                            T.StructField("_part", T.IntegerType()), T.StructField("_first_key", T.BooleanType()),
                            T.StructField("_first_peer", T.BooleanType()), T.StructField("_border", border)])
    border_type, names = to_arrow_type(border), counted.names
    at_key, at_order = df.columns.index(key), df.columns.index(order)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first, last = TaskContext.get().partitionId(), None, None, None
        in_key = in_peer = 0  # rows of the running key and pair so far
        keys_seen = peers_seen = first_rows = first_peers = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if held is not None:
                yield pa.RecordBatch.from_arrays([*held, pa.nulls(len(held[0]), border_type)], names)
            pair = [batch.column(at_key), batch.column(at_order)]
            new_key, new_peer = np.zeros(n, bool), np.zeros(n, bool)
            new_key[1:] = _changes(pair[0])
            new_peer[1:] = new_key[1:] | _changes(pair[1])
            now = [c[0].as_py() for c in pair]
            first = first or now
            if last is not None:
                new_key[0], new_peer[0] = now[0] != last[0], now != last
            last = [c[n - 1].as_py() for c in pair]
            place = np.arange(n)
            # Where the running key and pair began, counted from this batch's
            # first row (below 0 if in an earlier batch).
            key_at = np.maximum.accumulate(np.where(new_key, place, -in_key))
            peer_at = np.maximum.accumulate(np.where(new_peer, place, -in_peer))
            keys, peers = keys_seen + np.cumsum(new_key), peers_seen + np.cumsum(new_peer)
            keys_seen, peers_seen = int(keys[-1]), int(peers[-1])
            in_key, in_peer = n - int(key_at[-1]), n - int(peer_at[-1])
            first_rows += int((keys == 0).sum())
            first_peers += int((peers == 0).sum())
            held = [*batch.columns, pa.array(peer_at - key_at), pa.array(np.full(n, part, np.int32)),
                    pa.array(keys == 0), pa.array(peers == 0)]
        if held is not None:
            ends = dict(zip(border.names, [*first, first_rows, first_peers, *last, in_key, in_peer], strict=True))
            told = pa.array([None] * (len(held[0]) - 1) + [ends], border_type)
            yield pa.RecordBatch.from_arrays([*held, told], names)

    ranged.mapInArrow(count, counted).write.parquet(path)
    stored = spark.read.schema(counted).parquet(path)
    lines = (stored.where("_border IS NOT NULL").select("_part", "_border.*").orderBy("_part").collect())
    before = F.when(F.col("_first_key"), F.col("_key_rows")
                    - F.when(F.col("_first_peer"), F.col("_peer_rows")).otherwise(0)).otherwise(0)
    carried = spark.createDataFrame(_carried(lines), "_part int, _key_rows long, _peer_rows long")
    # One line for each partition that has rows: no more than there are tasks.
    joined = stored.drop("_border").join(F.broadcast(carried), "_part")
    return joined.select(*df.columns, (F.col("_before") + before + 1).alias(name))


def _carried(lines) -> list[tuple[int, int, int]]:
    """(partition, rows of its first key before it, and those of them that
    are of its first (key, order) pair as well)."""
    out, last, rows, peers = [], None, 0, 0
    for r in lines:
        key, pair = (r["key"],), (r["key"], r["order"])
        had = (rows if last and last[:1] == key else 0, peers if last == pair else 0)
        out.append((r["_part"], *had))
        rows, peers = r["last_rows"], r["last_peers"]
        if (r["last_key"],) == key:
            rows += had[0]
            peers += had[1] if (r["last_key"], r["last_order"]) == pair else 0
        last = (r["last_key"], r["last_order"])
    return out
