import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        active = [n for n in names if n not in fixed]
        rest = total - sum(fixed.values())
        share = {n: rest * weight[n] / sum(weight[x] for x in active) for n in active}
        over = [n for n in active if share[n] > 3 * sizes[n]]
        if not over:
            return fixed | share
        fixed |= {n: 3.0 * sizes[n] for n in over}


def test_report(docs, rows):
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = brute_targets(sizes)
    got = mixing.mix_report(docs).collect()
    assert sorted(str((r.doc_id, r.size)) for r in got) == sorted(str((r[0], size(r[1]))) for r in rows)
    by_size = {sizes[s]: t for s, t in want.items()}
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(by_size[r.source_size])
        assert r.taken <= 3 * r.size
        taken[r.source_size] += r.taken
    for s, t in want.items():
        largest = max(size(r[1]) for r in rows if r[3] == s)
        assert abs(taken[sizes[s]] - t) <= largest / 2 + 1
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_has_the_rows_the_report_says(docs):
    report = mixing.mix_report(docs).where("doc_id IS NOT NULL AND size > 0")
    want = {(r.doc_id, r.size): r.n for r in report.groupBy("doc_id", "size").agg(
        F.sum(F.col("taken") / F.col("size")).cast("long").alias("n")).collect()}
    out = mixing.mixed(docs, with_shard=True)
    assert out.columns == [*docs.columns, "__m_shard"]
    got = Counter()
    shards = Counter()
    for r in out.collect():
        shards[r["__m_shard"]] += 1
        n = len(WORD.findall(r.text or ""))
        if r.doc_id is not None and n:
            got[r.doc_id, n] += 1
    assert dict(got) == {k: n for k, n in want.items() if n}
    assert set(shards) <= set(range(64))
    assert mixing.mixed(docs).columns == docs.columns


def test_quotas_split_exactly_and_like_drawing_without_replacement(spark):
    quotas = spark.createDataFrame([(False, "a", 600), (False, "b", 37), (False, "c", 0), (True, "", 3)],
                                   "none boolean, source string, q long")
    means = defaultdict(float)
    for seed in range(6):
        rows = mixing.split_quotas(quotas, 8, seed).collect()
        total = Counter()
        for r in rows:
            total[r.source, r.none] += r.q
        assert total == {("a", False): 600, ("b", False): 37, ("c", False): 0, ("", True): 3}
        per_shard = Counter()
        for r in rows:
            per_shard[r.shard] += r.q
            means[r.source, r.shard] += r.q / 6
        assert set(per_shard.values()) == {80}
    for shard in range(8):
        assert abs(means["a", shard] - 75) < 4


def test_wide_sources_by_shuffle_join(docs, monkeypatch):
    want = sorted(map(str, mixing.mix_report(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix_report(docs).collect())) == want


def test_empty_table_and_native_plan(docs, empty):
    assert mixing.mix_report(empty).count() == 0
    assert mixing.mixed(empty).count() == 0
    plan = mixing.mixed(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_blocks_and_shards_grow_with_the_words(spark):
    # 8,192 shards of about 8 draws each, one source with a third of all rows.
    docs = spark.range(65_536).select(
        F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    mix = mixing.Mix(shard_words=32, shard_draws=8, block_documents=1, min_shards=64)
    out = mixing.mixed(docs, mix, with_shard=True).groupBy("__m_shard").count().collect()
    sizes = sorted(r["count"] for r in out)
    assert len(sizes) > 8_100 and max(r["__m_shard"] for r in out) > 8_000
    assert sizes[-1] < 5 * sum(sizes) / len(sizes)
    report = mixing.mix_report(docs, mix)
    assert report.agg(F.sum("taken")).first()[0] == 4 * sum(sizes)


def test_large_nodes_are_split_exactly_too(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "NODE_DRAWS", 100)
    quotas = spark.createDataFrame([(False, "a", 9_000), (False, "b", 370), (False, "c", 0), (True, "", 3)],
                                   "none boolean, source string, q long")
    rows = mixing.split_quotas(quotas, 16, 3).collect()
    total, per_shard = Counter(), Counter()
    for r in rows:
        total[r.source, r.none] += r.q
        per_shard[r.shard] += r.q
    assert total == {("a", False): 9_000, ("b", False): 370, ("c", False): 0, ("", True): 3}
    assert len(per_shard) == 16 and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert all(abs(r.q - 9_000 / 16) < 12 for r in rows if r.source == "a")
    assert all(r.q or r.shard == 0 for r in rows)
    monkeypatch.setattr(mixing, "NODE_DRAWS", 8)
    test_mix_has_the_rows_the_report_says(docs)


def test_blocks_by_shuffle_join(docs, monkeypatch):
    want = sorted(map(str, mixing.mix_report(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert sorted(map(str, mixing.mix_report(docs).collect())) == want


def test_plan_of_the_tree_does_not_grow_by_level(spark, capsys):
    quotas = spark.createDataFrame([(False, "a", 5_000), (True, "", 3)], "none boolean, source string, q long")

    def length(shards):
        mixing.split_quotas(quotas, shards, 3).explain()
        return len(capsys.readouterr().out)

    assert length(64) < 1.2 * length(2)


def test_tree_in_several_goes_equals_level_by_level(spark, monkeypatch):
    quotas = spark.createDataFrame([(False, "a", 900), (False, "b", 37), (False, "c", 0), (True, "", 3)],
                                   "none boolean, source string, q long")
    for shards in (2, 64, 512):
        together = sorted(map(tuple, mixing.split_quotas(quotas, shards, 5).collect()))
        with monkeypatch.context() as m:
            m.setattr(mixing, "LEVELS_AT_ONCE", 2)
            assert sorted(map(tuple, mixing.split_quotas(quotas, shards, 5).collect())) == together
        assert sum(r[3] for r in together) == 940
