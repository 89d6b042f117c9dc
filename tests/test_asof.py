import datetime as dt
import random

import pytest

from ledgerline.operators.asof import as_of_join

START = dt.datetime(2024, 1, 1)


def data(seed, n=400):
    rng = random.Random(seed)
    when = lambda: None if rng.random() < 0.03 else START + dt.timedelta(hours=rng.randrange(24 * 12))
    user = lambda: 7 if rng.random() < 0.4 else None if rng.random() < 0.05 else rng.randrange(9)
    left = [(k, user(), when()) for k in range(n)]
    right = [(user(), when(), rng.randrange(1000), rng.choice("ab")) for _ in range(n // 3)]
    return left, right + right[:5]


def plain(left, right):
    out = []
    for k, user, ts in left:
        best = max(((t, i, v) for u, t, i, v in right if u is not None and u == user and t is not None
                    and ts is not None and t <= ts), default=(None, None, None))
        out.append((k, user, ts, *best))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("hours", [24, 6, 1])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_equals_plain(spark, hours, kind):
    left, right = data(hours)
    ldf = spark.createDataFrame(left, "k long, user_id long, ts timestamp").selectExpr(
        "k", "user_id", f"CAST(ts AS {kind}) AS ts").repartition(3)
    rdf = spark.createDataFrame(right, "user_id long, at timestamp, snap long, v string").selectExpr(
        "user_id", f"CAST(at AS {kind}) AS at", "snap", "v").repartition(3)
    got = as_of_join(ldf, rdf, "user_id", "ts", "at", "snap", hours=hours)
    assert got.columns == ["k", "user_id", "ts", "at", "snap", "v"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == plain(left, right)


def test_empty_sides_and_clashes(spark):
    left, right = data(1, 30)
    ldf = spark.createDataFrame(left, "k long, user_id long, ts timestamp")
    rdf = spark.createDataFrame(right, "user_id long, at timestamp, snap long, v string")
    assert as_of_join(ldf.limit(0), rdf, "user_id", "ts", "at").collect() == []
    assert {r.snap for r in as_of_join(ldf, rdf.limit(0), "user_id", "ts", "at").collect()} == {None}
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(ldf, rdf.withColumnRenamed("at", "ts"), "user_id", "ts", "ts")
    with pytest.raises(ValueError, match="divide"):
        as_of_join(ldf, rdf, "user_id", "ts", "at", hours=5)


def test_a_large_key_is_many_groups(spark):
    left, right = data(2)
    ldf = spark.createDataFrame(left, "k long, user_id long, ts timestamp")
    rdf = spark.createDataFrame(right, "user_id long, at timestamp, snap long, v string")
    plan = as_of_join(ldf, rdf, "user_id", "ts", "at")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k#" in plan and ", _s#" in plan and "Join" not in plan
