import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(fps):
    """fps: list of ints -> index of the first member of each one's component."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_report_equals_brute_force(docs, rows):
    fps = [brute_fp(r[1]) for r in rows]
    heads = brute_components(fps)
    first = {}
    for k, r in enumerate(rows):
        ids = [i for i in (first.get(heads[k]), r[0]) if i is not None]
        first[heads[k]] = min(ids) if ids else None
    want = sorted((str(r[0]), f"{fps[k]:016x}", str(first[heads[k]])) for k, r in enumerate(rows))
    got = simhash.simhash_report(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_one_row_of_each_group_stays(docs, rows):
    heads = brute_components([brute_fp(r[1]) for r in rows])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(heads))
    group = {(r[0], r[1]): h for r, h in zip(rows, heads)}
    assert len({group[g] for g in got}) == len(got)
    assert {20} <= {i for i, _ in got} and not {21, 45} & {i for i, _ in got}


@pytest.mark.parametrize("largest", [100, 256])
def test_crowded_buckets_lose_no_pair(spark, monkeypatch, largest):
    """A ball of near fingerprints and random ones, for any bucket bound."""
    rng = random.Random(1)
    center = rng.getrandbits(64)
    fps = {center} | {center ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(600)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    monkeypatch.setattr(simhash, "MAX_BUCKET", largest)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    pairs = simhash.close_pairs(spark.createDataFrame(signed, "fp long"))
    got = {(a % (1 << 64), b % (1 << 64)) for a, b in pairs.collect()}
    want = {(a, b) for a in fps for b in fps if 0 < (a ^ b).bit_count() <= 2}
    assert {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in want}
    assert pairs.count() == len(want) // 2


def test_long_chain_is_one_component(spark):
    n = 300
    pairs = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = simhash.components(pairs).collect()
    assert len(labels) == n + 1 and {r.label for r in labels} == {0}


def test_empty_table(empty):
    assert simhash.simhash_report(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
