"""File sources: CSV sales (S1), nested user documents (S4), snapshots.

Every reader fails on text that does not parse: a broken record never
becomes a row of NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas

# How quotes are written inside a quoted CSV field.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header row, columns found by their header name and typed by
    ``schema`` (no inference pass; the header of one file is read first).

    An empty field, quoted or not, is NULL, as in the original's reader.
    A column of ``schema`` that the header lacks, a file whose header differs
    from the first one's, or a field that does not parse fails the read.
    ``multiline`` admits line breaks inside quoted fields; such files are not
    split, so it costs parallelism on large ones.
    """
    reader = spark.read.options(header=True, mode="FAILFAST", multiLine=multiline, **CSV_QUOTES)
    header = reader.csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    known = {f.name: f for f in schema.fields}
    in_file = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    return (reader.option("enforceSchema", False).schema(in_file).csv(path)
            .select(*[f.name for f in schema.fields]))


def read_sales_csv(spark: SparkSession, path: str, schema=schemas.CSV_SALES,
                   multiline: bool = False) -> DataFrame:
    """The sales file; see ``read_csv``."""
    return read_csv(spark, path, schema, multiline)


def read_raw_json(spark: SparkSession, path: str, schema=schemas.RAW_SALES) -> DataFrame:
    """Newline-delimited raw sales records."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_user_docs(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """User documents, one JSON object per file (or per line)."""
    return (spark.read.schema(schemas.USER_DOC).option("multiLine", multiline)
            .option("mode", "FAILFAST").json(path))


def read_snapshots(spark: SparkSession, path: str, multiline: bool = True,
                   ts_col: str | None = None) -> DataFrame:
    """Snapshot documents with a ``results`` array. ``snapshot_ts`` is the
    partition column ``ts_col`` of a dated path (``.../<ts_col>=.../``);
    without one, the file's modification time, which a copy changes."""
    schema = schemas.SNAPSHOT_DOC
    if ts_col:
        schema = T.StructType([*schema.fields, T.StructField(ts_col, T.TimestampNTZType())])
    df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    taken = F.col(ts_col) if ts_col else F.col("_metadata.file_modification_time")
    return df.select("results", "info", taken.alias("snapshot_ts"),
                     F.col("_metadata.file_path").alias("source_file"))
