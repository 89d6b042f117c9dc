"""Inputs that are dear to evaluate are gone through once."""

import datetime as dt

from ledgerline.operators.partials import partial_names
from ledgerline.sinks.files import write_transformed
from ledgerline.streaming import summary


def counted(df):
    """``df``, and an accumulator of the rows evaluated for it."""
    rows = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), rows


def test_curve_evaluates_its_input_once(spark, tmp_path):
    data = [(k, dt.date(2024, 1, 1 + k % 3), f"r{k % 4}", None if k % 5 == 0 else f"p{k % 7}") for k in range(60)]
    df, rows = counted(spark.createDataFrame(data, "order_id long, order_date date, region string, product string"))
    path = str(tmp_path / "table")
    write_transformed(df, path, curve=True)
    assert rows.value == 60
    found = spark.read.parquet(path).select("order_id", "order_date", "region", "product").collect()
    assert sorted(map(tuple, found)) == sorted(data)


def test_a_batch_evaluates_its_state_once(spark, tmp_path):
    names = partial_names()
    data = [(dt.datetime(2024, 1, 1 + k % 2), k, *[k] * len(names)) for k in range(20)]
    schema = "summary_date timestamp, customer_id long, " + ", ".join(f"{n} long" for n in names)
    df, rows = counted(spark.createDataFrame(data, schema))
    summary._upsert(df, str(tmp_path / "summary"), 0)
    assert rows.value == 20
    found = spark.read.parquet(str(tmp_path / "summary" / "summary" / "batch=0"))
    assert {(r["summary_date"].day, r["unique_customers"], r["total_orders"]) for r in found.collect()} == {
        (1, 10, 90), (2, 10, 100)}
    assert not (tmp_path / "summary" / "arrived" / "batch=0").exists()
