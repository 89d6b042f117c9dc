import datetime as dt
import json
import os

import pytest

from ledgerline.streaming import commit_log, ingest
from ledgerline.streaming.ingest import ingest_new_files

REC = {"order_id": 1, "customer_id": 5, "product": "Widget A", "quantity": 1, "price": 2.0,
       "total_amount": 2.0, "order_date": "2024-01-15", "region": "North", "channel": "Online"}


@pytest.fixture()
def place(tmp_path):
    os.makedirs(tmp_path / "in put")
    return {"source_dir": str(tmp_path / "in put"), "target": str(tmp_path / "ta ble"),
            "checkpoint": str(tmp_path / "c")}


def put(place, first, n, rows=1):
    for k in range(first, first + n):
        with open(os.path.join(place["source_dir"], f"f{k:05d}.json"), "w") as f:
            for i in range(rows):
                day = dt.date(2024, 1, 1 + (k + i) % 3).isoformat()
                f.write(json.dumps(REC | {"order_id": 1000 * k + i, "order_date": day}) + "\n")


def test_many_batches_are_counted_from_the_log(spark, place):
    """Over several compactions of the log (test_inputs has more batches than
    Spark keeps reports of)."""
    put(place, 0, 21)
    assert ingest_new_files(spark, **place, max_files_per_trigger=1) == 21
    names = os.listdir(os.path.join(place["target"], commit_log.LOG))
    assert "19.compact" in names
    put(place, 21, 7, rows=5)
    assert ingest_new_files(spark, **place, max_files_per_trigger=2) == 35
    assert spark.read.parquet(place["target"]).count() == 56


def test_crash_between_commit_and_return(spark, place, monkeypatch):
    put(place, 0, 6, rows=2)
    monkeypatch.setattr(ingest, "stored_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest_new_files(spark, **place, max_files_per_trigger=1, run_id="monday")
    monkeypatch.undo()
    assert spark.read.parquet(place["target"]).count() == 12      # all was stored
    assert ingest_new_files(spark, **place, run_id="monday") == 12
    put(place, 6, 1)
    assert ingest_new_files(spark, **place, run_id="monday") == 12  # that run is over
    assert ingest_new_files(spark, **place, run_id="tuesday") == 1
    assert ingest_new_files(spark, **place) == 0


def test_crash_between_batches(spark, place):
    """A broken file stops the run after some batches; mended, the same run
    counts those too."""
    put(place, 0, 5, rows=3)
    broken = os.path.join(place["source_dir"], "f00004.json")
    with open(broken) as f:
        good = f.read()
    with open(broken, "w") as f:
        f.write("{")
    os.utime(broken, (2e9, 2e9))  # the newest: read last
    with pytest.raises(Exception):  # noqa: B017
        ingest_new_files(spark, **place, max_files_per_trigger=1, run_id="r")
    assert spark.read.parquet(place["target"]).count() == 12
    with open(broken, "w") as f:
        f.write(good)
    assert ingest_new_files(spark, **place, max_files_per_trigger=1, run_id="r") == 15


def test_log_of_an_absent_table_is_empty(spark, tmp_path):
    assert commit_log.committed_files(spark, str(tmp_path / "none")) == []
