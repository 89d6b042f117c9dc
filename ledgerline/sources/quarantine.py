"""Reading with a quarantine: rows and rejects in one pass.

The strict readers fail at the first record that does not parse. Here such
records are kept apart, with their text, the reason and the file, up to a
limit that is counted. One job reads the input and writes both; a batch
counts only once its marker is written, so rows and rejects are committed
together or not at all.

Layout: ``batches/batch=<batch>/rejected={false,true}`` and
``accepted/<batch>``.
A batch over the limit is left unaccepted for inspection.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.files import CSV_QUOTES
from ledgerline.storage import Store

REJECT_FIELDS = [T.StructField("reject_reason", T.StringType()), T.StructField("reject_text", T.StringType()),
                 T.StructField("source_file", T.StringType())]
NOT_JSON, NOT_TYPED = "not a JSON object", "a field does not fit its type"
NOT_CSV = "a field does not fit its type, or the number of fields is wrong"


class TooManyRejects(ValueError):
    """More records were rejected than the limit allows."""


@dataclass(frozen=True)
class Accepted:
    batch: str
    rows: int
    rejects: int


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                      required: tuple[str, ...] = ()) -> DataFrame:
    """Every record: the fields of ``schema``, all null for a reject, and
    ``reject_reason`` (null for a good row), ``reject_text``, ``source_file``.
    A null in a ``required`` field rejects a record as well."""
    raw = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(raw).options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False, **CSV_QUOTES)
    elif fmt != "json":
        raise ValueError(f"no quarantine for {fmt}")
    bad, text = F.col("_corrupt_record"), F.col("_corrupt_record")
    why = F.when(bad.isNotNull(), F.lit(NOT_CSV) if fmt == "csv" else
                 F.when(F.json_object_keys(bad).isNull(), NOT_JSON).otherwise(NOT_TYPED))
    whole = F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})
    for name in required:
        why = F.coalesce(why, F.when(F.col(name).isNull(), F.lit(f"no {name}")))
    records = reader.format(fmt).load(path).withColumn("reject_reason", why).withColumn(
        "reject_text", F.when(F.col("reject_reason").isNotNull(), F.coalesce(text, whole)))
    good = F.col("reject_reason").isNull()
    return records.select(*[F.when(good, F.col(n)).alias(n) for n in schema.names], "reject_reason", "reject_text",
                          F.when(~good, F.col("_metadata.file_path")).alias("source_file"))


def take_in(spark: SparkSession, source: str, path: str, schema: T.StructType, fmt: str = "json",
            required: tuple[str, ...] = (), max_rejects: int | None = None, batch: str | None = None) -> Accepted:
    """Store the records under ``source`` as one batch. With more than
    ``max_rejects`` rejects nothing is committed and the call fails. A rerun
    with the same ``batch`` replaces it."""
    store, batch = Store(spark), batch or uuid.uuid4().hex
    folder, mark = f"{path}/batches/batch={batch}", f"{path}/accepted/{batch}"
    store.delete(mark)
    records = read_with_rejects(spark, source, schema, fmt, required)
    (records.withColumn("rejected", F.col("reject_reason").isNotNull())
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(folder))
    stored = _stored(spark, path, [batch], schema)
    # From the footers: no column is read.
    rows, rejects = (stored.where(c).count() for c in ("NOT rejected", "rejected"))
    if max_rejects is not None and rejects > max_rejects:
        raise TooManyRejects(f"{rejects} of {rows + rejects} records of batch {batch} rejected, {max_rejects} allowed")
    store.write_text(mark, "")
    return Accepted(batch, rows, rejects)


def _stored(spark: SparkSession, path: str, batches: list[str], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, *REJECT_FIELDS, T.StructField("batch", T.StringType()),
                         T.StructField("rejected", T.BooleanType())])
    if not batches:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full).option("basePath", f"{path}/batches")
            .parquet(*[f"{path}/batches/batch={b}" for b in batches]))


def _accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _stored(spark, path, Store(spark).names(f"{path}/accepted"), schema)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Good rows of all accepted batches."""
    return _accepted(spark, path, schema).where("NOT rejected").select(*schema.names)


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rejects of all accepted batches."""
    return _accepted(spark, path, schema).where("rejected").select(*[f.name for f in REJECT_FIELDS])
