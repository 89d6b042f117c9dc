import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.users import (
    dedupe_by_key, flatten_users, latest_snapshot, new_rows_by_key, records_to_json,
    split_snapshot, stamp_created, to_user_rows,
)
from ledgerline.plans.jobs import run_users
from ledgerline.sinks.files import append_by_key, read_users


def _doc(i, first="Ann", last="Lee"):
    return json.dumps({"id": str(i), "personalInfo": {"firstName": first, "lastName": last,
                                                      "email": f"{first}.{last}@example.com"}})


def test_flatten_and_stamp(spark):
    docs = spark.createDataFrame([(_doc(1),), ('{"id": "2"}',)], "value string")
    flat = {r.id: r for r in flatten_users(docs).collect()}
    assert flat["1"].firstname == "Ann" and flat["1"].email == "Ann.Lee@example.com"
    assert flat["2"].firstname is None                      # missing struct
    stamped = stamp_created(flatten_users(docs), dt.datetime(2025, 6, 17, 4, 24, 45)).first()
    assert stamped.created_at == "2025-06-17 04:24:45"


def test_keyed_append_rerun_and_repeats(spark, tmp_path):
    docs = spark.createDataFrame([(_doc(1),), (_doc(1),), (_doc(2, "Bo"),)], "value string")
    flat = stamp_created(flatten_users(docs), dt.datetime(2025, 1, 1), as_text=False)
    path = str(tmp_path / "users")
    assert append_by_key(flat, path).count() == 2            # repeated id kept once
    assert append_by_key(flat, path).count() == 0            # rerun: no duplicate-key failure
    more = spark.createDataFrame([(_doc(3, "Cy"),), (_doc(2, "Xx"),)], "value string")
    append_by_key(stamp_created(flatten_users(more), dt.datetime(2025, 1, 2), as_text=False), path)
    table = {r.id: r.firstName for r in read_users(spark, path).collect()}
    assert table == {1: "Ann", 2: "Bo", 3: "Cy"}             # stored key not replaced


def test_non_numeric_id_fails(spark):
    docs = spark.createDataFrame([('{"id": "abc"}',)], "value string")
    rows = to_user_rows(stamp_created(flatten_users(docs), dt.datetime(2025, 1, 1), as_text=False))
    with pytest.raises(Exception):
        rows.collect()


def test_dedupe_and_anti_join(spark):
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "z")], "id int, v string")
    assert {tuple(r) for r in dedupe_by_key(batch.filter("id is not null")).collect()} == {(1, "a"), (2, "c")}
    existing = spark.createDataFrame([(2,)], "id int")
    keyed = batch.filter("id is not null")
    assert [tuple(r) for r in new_rows_by_key(keyed, existing).collect()] == [(1, "a")]
    assert {tuple(r) for r in new_rows_by_key(keyed, None).collect()} == {(1, "a"), (2, "c")}
    with pytest.raises(Exception, match="a row has no id"):
        new_rows_by_key(batch, existing).collect()


def _snap(user, ts, sid, city, results=True, postcode=1234):
    doc = {"results": ([{"location": {"city": city, "postcode": postcode, "street": {"number": 1, "name": "x"}},
                         "login": {"uuid": f"u{sid}", "username": "n", "password": "secret"}}]
                       if results else []),
           "info": {"seed": "s", "results": 1, "page": 1, "version": "1.4"}}
    return (user, ts, sid, json.dumps(doc))


def test_latest_snapshot_three_snapshots(spark):
    t = dt.datetime
    rows = [_snap(1, t(2025, 6, 17, 22, 0), 1, "Zuidhorn"), _snap(1, t(2025, 6, 18), 2, "Bergen"),
            _snap(1, t(2025, 6, 19), 3, "Oslo"), _snap(2, t(2025, 6, 18), 4, "Kyiv", results=False),
            _snap(1, t(2025, 6, 18), 0, "Tie-loser")]
    snaps = spark.createDataFrame(rows, "user_id long, snapshot_ts timestamp, snapshot_id long, doc string")
    latest = latest_snapshot(snaps, t(2025, 6, 18, 12, 0))
    loc, login = split_snapshot(latest, drop_fields=("password",))
    cities = {r.user_id: r.city for r in loc.collect()}
    assert cities == {1: "Bergen", 2: None}                 # as-of between 2nd and 3rd; empty results
    assert "password" not in login.columns
    assert {r.user_id: r.postcode for r in loc.collect()}[1] == "1234"   # number read as text
    overall = latest_snapshot(snaps, None, keys=())
    assert overall.first().snapshot_id == 3


def test_records_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    assert json.loads(records_to_json(df).first().json) == {"a": 1, "b": None}


def test_run_users_job(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "u.json").write_text(json.dumps({"id": "1293234", "personalInfo": {
        "firstName": "Cyriac", "lastName": "Dupont", "email": "c@example.com"}}))
    table = str(tmp_path / "table")
    assert run_users(spark, str(docs), table).count() == 1
    assert run_users(spark, str(docs), table).count() == 0
    assert read_users(spark, table).filter(F.col("id") == 1293234).count() == 1
