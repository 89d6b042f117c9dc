"""The daily summary kept up to date batch by batch (A2, K5).

For every batch of new rows two small tables are stored: partial sums per
date, and the distinct (date, customer) pairs, each combined in the tasks
before any shuffle. A date's figures are the sums over the batches and the
number of distinct pairs, so a late row costs a recomputation of its date
from these tables, and the sales rows are not read again.

Layout: ``state/batch=N/{sums,customers}``, ``applied/N`` (empty files, made
when a batch's state is complete; state without one is not read), and
``summary/batch=N``: the finished rows of the dates that batch N touched. Of
a date, the row of the latest batch holds. Everything of a batch lies in
folders of its own, which a rerun of the batch replaces.

A rerun must bring the batch's rows again, not others. Batch numbers must
grow. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators.partials import finished, merged_columns, partial_columns, partial_names, with_limbs
from ledgerline.storage import Store

SUMS = T.StructType([T.StructField("summary_date", T.DateType()),
                     *[T.StructField(n, T.LongType()) for n in partial_names()]])
CUSTOMERS = T.StructType([T.StructField("summary_date", T.DateType()), T.StructField("customer_id", T.LongType())])


def apply_batch(enriched: DataFrame, path: str, batch: int) -> DataFrame:
    """Adds a batch of enriched rows; returns the summary rows it changed."""
    spark, store = enriched.sparkSession, Store(enriched.sparkSession)
    folder = f"{path}/state/batch={batch}"
    rows = with_limbs(enriched.withColumn("summary_date", F.col("order_date")))
    # One shuffle of (date, customer) partial sums gives both tables.
    pairs = rows.groupBy("summary_date", "customer_id").agg(*partial_columns())
    pairs.write.mode("overwrite").parquet(f"{folder}/pairs")
    pairs = spark.read.schema(pairs.schema).parquet(f"{folder}/pairs")
    (pairs.groupBy("summary_date").agg(*merged_columns()).coalesce(1).sortWithinPartitions("summary_date")
     .write.mode("overwrite").parquet(f"{folder}/sums"))
    (pairs.where("customer_id IS NOT NULL").select(*CUSTOMERS.names).repartitionByRange(*CUSTOMERS.names)
     .sortWithinPartitions(*CUSTOMERS.names).write.mode("overwrite").parquet(f"{folder}/customers"))
    store.delete(f"{folder}/pairs")
    store.write_text(f"{path}/applied/{batch}", "")

    # A batch has as many dates as it has days, however many rows.
    touched = [r[0] for r in spark.read.schema(SUMS).parquet(f"{folder}/sums").select("summary_date").collect()]
    dates = F.col("summary_date").isin(*[d for d in touched if d is not None])
    dates = dates | F.col("summary_date").isNull() if None in touched else dates
    sums = _state(spark, path, "sums", SUMS).where(dates).groupBy("summary_date").agg(*merged_columns())
    customers = (_state(spark, path, "customers", CUSTOMERS).where(dates).groupBy("summary_date")
                 .agg(F.countDistinct("customer_id").alias("unique_customers")))
    return write_version(finished(with_customers(sums, customers)), path, batch)


def with_customers(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """Both sides have one row a date; a date whose customers are all null
    has no row among them."""
    c = customers.withColumnRenamed("summary_date", "_d")
    return (sums.join(c, F.col("summary_date").eqNullSafe(F.col("_d")), "left").drop("_d")
            .withColumn("unique_customers", F.coalesce("unique_customers", F.lit(0).cast("long"))))


def _state(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    batches = Store(spark).names(f"{path}/applied")
    return spark.read.schema(schema).parquet(*[f"{path}/state/batch={b}/{name}" for b in batches])


def write_version(summary: DataFrame, path: str, batch: int) -> DataFrame:
    """One row a date: few enough for one file."""
    folder = f"{path}/summary/batch={batch}"
    summary.repartition(1).sortWithinPartitions("summary_date").write.mode("overwrite").parquet(folder)
    return summary.sparkSession.read.schema(schemas.DAILY_SUMMARY).parquet(folder)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary as of the last batch, one row a date."""
    names = schemas.DAILY_SUMMARY.names
    if not Store(spark).names(f"{path}/summary"):
        return spark.createDataFrame([], schemas.DAILY_SUMMARY)
    schema = T.StructType([*schemas.DAILY_SUMMARY.fields, T.StructField("batch", T.LongType())])
    versions = spark.read.schema(schema).parquet(f"{path}/summary")
    latest = F.max_by(F.struct(*names), "batch").alias("row")
    return versions.groupBy("summary_date").agg(latest).select("row.*")
