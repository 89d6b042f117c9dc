"""Clustering on several columns along a Z-order curve.

A sort on (region, product) serves filters on region; rows of one product
are in every file. On the curve, rows are ordered by the interleaved bits of
all columns' ranks, so that a file holds a small box of values and a filter
on any of the columns skips most files.

A rank is a value's place among splitters, quantiles of a bounded sample
(``SAMPLE_ROWS``). They steer where rows lie, never which rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows looked at to place the splitters.
SAMPLE_ROWS = 20_000
BITS = 5


def splitters(df: DataFrame, column: str, bits: int = BITS) -> list:
    """At most 2**bits - 1 values that cut the column's values about evenly."""
    values = df.select(column).where(F.col(column).isNotNull())
    share = min(1.0, SAMPLE_ROWS / max(1, values.count()))
    sample = sorted(r[0] for r in values.sample(share, seed=7).limit(2 * SAMPLE_ROWS).collect())
    n = 1 << bits
    cuts = [sample[len(sample) * k // n] for k in range(1, n)] if sample else []
    # A value that fills several parts is one cut.
    return sorted(set(cuts))


def curve(ranks: list[Column], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, the first column's foremost."""
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            place = bit * len(ranks) + len(ranks) - 1 - k
            z = z.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), place))
    return z


def z_value(df: DataFrame, columns, bits: int = BITS) -> Column:
    """Place of a row on the curve through ``columns`` (null: first)."""
    return curve([_rank(F.col(c), splitters(df, c, bits)) for c in columns], bits)


def _rank(value: Column, cuts: list) -> Column:
    below = F.size(F.filter(F.lit(cuts), lambda cut: cut <= value)) if cuts else F.lit(0)
    return F.when(value.isNull(), 0).otherwise(below).cast("long")


def along_curve(df: DataFrame, partition_col: str, columns, tiebreak: str, files: int | None = None) -> DataFrame:
    """Rows shuffled and sorted by (partition, curve), so that each writer
    task, and with it each file, holds one stretch of the curve. A partition
    of any size takes as many tasks as it needs; equal places are spread by
    ``tiebreak``. ``files`` sets the number of tasks (default: the shuffle
    partitions, merged by AQE where they are small)."""
    placed = df.withColumn("_z", z_value(df, columns))
    keys = [partition_col, "_z", tiebreak]
    ranged = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(partition_col, "_z", *columns, tiebreak).drop("_z")


def file_ranges(table: DataFrame, columns) -> DataFrame:
    """Smallest and largest value of each column in every file of a table."""
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def files_hit(ranges: DataFrame, **values) -> tuple[int, int]:
    """(files that a filter on these column values has to read, all files)."""
    hit = F.lit(True)
    for c, v in values.items():
        hit = hit & F.lit(v).between(F.col(f"min_{c}"), F.col(f"max_{c}"))
    r = ranges.agg(F.count_if(hit).alias("hit"), F.count(F.lit(1)).alias("n")).first()
    return r["hit"], r["n"]
