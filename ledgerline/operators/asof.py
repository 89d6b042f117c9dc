"""W2 for every row at its own time: an as-of join.

Both sides go into one frame, sorted by (key, time), and each left row takes
the last right row above it. A key is divided into slices of time, so a key
of any size is many groups; what a slice begins with, the key's last right
row of earlier slices, comes from one row per (key, slice) and enters the
slice as a row before all others. There is no join and no pair of rows that
does not match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_HOURS = 24
_CARRIED, _RIGHT, _LEFT = -1, 0, 1


def _slice(ts: Column, hours: int) -> Column:
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * (DAY_HOURS // hours) + F.floor(F.hour(ts) / hours)


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
               tiebreak: str | None = None, hours: int = DAY_HOURS) -> DataFrame:
    """``left`` with the columns of ``right`` (but the key) from the right
    row of the same key with the latest time at or before the left row's;
    nulls where there is none. Right rows of equal key and time: the one
    with the largest ``tiebreak``, and of equal ones the largest row.

    A null key or time matches nothing. ``hours``, a divisor of 24, is the
    length of a slice; it changes the plan's grain, not the result.
    """
    if DAY_HOURS % hours:
        raise ValueError("hours must divide 24")
    clash = sorted((set(left.columns) & set(right.columns)) - {key})
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    values = [c for c in right.columns if c != key]
    order = [right_ts] + ([tiebreak] if tiebreak else [])
    found = F.struct(*[F.col(c) for c in order + [c for c in values if c not in order]])
    right = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
    told = right.select(F.col(key).alias("_k"), F.col(right_ts).alias("_t"), F.lit(_RIGHT).alias("_side"),
                        found.alias("_r"), F.lit(None).cast(_struct_of(left)).alias("_l"))
    asked = left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_t"), F.lit(_LEFT).alias("_side"),
                        F.lit(None).cast(told.schema["_r"].dataType).alias("_r"),
                        F.struct(*[F.col(c) for c in left.columns]).alias("_l"))
    rows = told.unionByName(asked).withColumn("_s", _slice(F.col("_t"), hours))

    # One row per (key, slice): the last right row of the slices before it.
    ends = rows.groupBy("_k", "_s").agg(F.max("_r").alias("_r"))
    earlier = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.withColumn("_r", F.last("_r", ignorenulls=True).over(earlier)).where("_r IS NOT NULL")
               .select("_k", F.lit(None).cast(rows.schema["_t"].dataType).alias("_t"),
                       F.lit(_CARRIED).alias("_side"), "_r",
                       F.lit(None).cast(rows.schema["_l"].dataType).alias("_l"), "_s"))
    above = Window.partitionBy("_k", "_s").orderBy(
        F.col("_t").asc_nulls_first(), "_side", F.col("_r").asc_nulls_first()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = (rows.unionByName(carried).withColumn("_m", F.last("_r", ignorenulls=True).over(above))
               .where(F.col("_side") == _LEFT))
    return matched.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns],
                          *[F.when(F.col("_t").isNotNull(), F.col(f"_m.{c}")).alias(c) for c in values])


def _struct_of(df: DataFrame):
    from pyspark.sql import types as T
    return T.StructType(df.schema.fields)
