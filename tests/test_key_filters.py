import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.sinks import files
from ledgerline.sinks.files import append_by_key, read_users, truncate_table
from ledgerline.sinks.key_filters import blocks_for, folders_to_read, write_filter
from ledgerline.storage import Store


def users(spark, ids):
    return spark.createDataFrame([(str(k), f"f{k}", "l", f"{k}@x") for k in ids],
                                 "id string, firstname string, lastname string, email string")


def test_sizes():
    assert [blocks_for(n) for n in (0, 1, 2730, 2731, 5462, 10 ** 9)] == [1, 1, 1, 2, 4, 1 << 19]


def test_no_stored_key_is_missed(spark, tmp_path):
    """Filters of several sizes; every folder of a stored key is named."""
    data, filters = str(tmp_path / "data"), str(tmp_path / "filters")
    bounds = [0, 10, 4000, 4001, 16000, 16100]
    for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        rows = spark.range(lo, hi).withColumnRenamed("id", "k")
        rows.write.parquet(f"{data}/batch=b{b}")
        write_filter(rows, "k", hi - lo, f"{filters}/batch=b{b}")
    for b, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        got = folders_to_read(spark, data, filters, spark.range(hi - 1, hi).withColumnRenamed("id", "k"), "k")
        assert f"batch=b{b}" in got and len(got) <= 2
    assert len(folders_to_read(spark, data, filters, spark.range(0, 16100).withColumnRenamed("id", "k"), "k")) == 5
    strangers = spark.range(10 ** 6, 10 ** 6 + 20).withColumnRenamed("id", "k")
    assert len(folders_to_read(spark, data, filters, strangers, "k")) <= 1
    Store(spark).delete(f"{filters}/batch=b2")          # as after a crash before it was written
    assert "batch=b2" in folders_to_read(spark, data, filters, strangers, "k")
    assert folders_to_read(spark, str(tmp_path / "no"), filters, strangers, "k") == []


@pytest.mark.parametrize("prune_keys", [10 ** 6, 0])
def test_append_reads_only_folders_that_may_hold_a_key(spark, tmp_path, monkeypatch, prune_keys):
    path, read = str(tmp_path / "t"), []
    for b in range(8):
        append_by_key(users(spark, range(100 * b, 100 * b + 100)), path, created_at="2025-01-01")
    original = files._read_folders
    monkeypatch.setattr(files, "_read_folders", lambda s, f: read.append(f) or original(s, f))
    batch = [5, 6, 7, 7, 9001, 9001, 9002, 730]
    added = append_by_key(users(spark, batch), path, created_at="2025-01-02", prune_keys=prune_keys)
    assert sorted(r.id for r in added.collect()) == [9001, 9002]
    if prune_keys:
        assert 2 <= len(read[-1]) <= 4 and all("batch=" in f for f in read[-1])
    else:
        assert read[-1] == [f"{path}/data"]
    monkeypatch.undo()
    assert read_users(spark, path).count() == 802
    assert read_users(spark, path).where(F.col("created_at") >= "2025-01-02").count() == 2


def test_truncate_takes_the_filters_along(spark, tmp_path):
    path = str(tmp_path / "t")
    append_by_key(users(spark, [1, 2]), path)
    truncate_table(spark, path, schemas.USERS)
    assert os.listdir(tmp_path) in ([], ["t"])
    assert append_by_key(users(spark, [1]), path).count() == 1
