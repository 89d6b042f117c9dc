import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from ledgerline.llm import periodic
from ledgerline.llm.queries import with_repeats


def plain_runs(w):
    """(start, length, period) by trying every period at every place."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        k = 0
        while k < len(w) - q:
            if w[k] != w[k + q]:
                k += 1
                continue
            stop = k
            while stop < len(w) - q and w[stop] == w[stop + q]:
                stop += 1
            run = w[k:stop + q]
            if len(run) >= max(6, 4 * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                out.append((k, len(run), q))
            k = stop
    return sorted(out, key=lambda r: (r[0], r[2]))


def damaged_words(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def plain_report(w):
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_wavelet_tree():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 501):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values.astype(np.int64))
        lo = rng.integers(0, n + 1, 300)
        hi = np.minimum(n, lo + rng.integers(0, n + 1, 300))
        x = rng.integers(0, n + 3, 300)
        want = [min((v for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(lo, hi, x, strict=True)]
        assert tree.successor(lo, hi, x).tolist() == want
        assert tree.below(lo, hi, x).tolist() == [
            sum(v < c for v in values[a:b]) for a, b, c in zip(lo, hi, x, strict=True)]


def test_runs_equal_plain():
    rng = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3, 30])
            w = [rng.randrange(k) for _ in range(rng.randint(0, 90))]
            if w and rng.random() < 0.6:
                a, p = rng.randrange(len(w)), rng.randint(1, 12)
                w = w[:a] + [w[a + (i - a) % p] if a + (i - a) % p < len(w) else w[i] for i in range(a, len(w))]
            if rng.random() < 0.4:
                u = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
                w += u * rng.randint(2, 8) + [7] + u * rng.randint(3, 6)
            docs.append(w)
        offsets = np.concatenate(([0], np.cumsum([len(w) for w in docs])))
        words = np.array([x for w in docs for x in w], np.int32)
        assert periodic.runs_of(words, offsets) == [(d, *r) for d, w in enumerate(docs) for r in plain_runs(w)]


def test_long_runs_and_fibonacci():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    long = [3, 1, 4, 1, 5] * 5000
    offsets = np.array([0, len(b), len(b) + len(long)])
    got = periodic.runs_of(np.array(b + long, np.int32), offsets)
    assert got == [(0, *r) for r in plain_runs(b)] + [(1, 0, len(long), 5)]


def test_report_equals_plain(spark, docs, rows, empty):
    got = sorted((str(r["doc_id"]), tuple(r)[1:]) for r in periodic.runs_report(docs).collect())
    want = sorted((str(r[0]), plain_report(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows if r[0] != 7)
    assert [g for g in got if g[0] != "7"] == want and len(got) == len(rows)
    assert periodic.runs_report(empty).collect() == []


def test_planted_repeats(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_BYTES", 3000)
    extra = spark.createDataFrame([(k, f"w{k} " * (k % 7) + " ".join(f"x{i % (k % 5 + 2)}" for i in range(k)))
                                   for k in range(200, 420)], "doc_id long, text string")
    some = docs.where("doc_id is null or doc_id <> 7").select("doc_id", "text").unionByName(extra)
    got = sorted((str(r["doc_id"]), tuple(r)[1:]) for r in periodic.runs_report(with_repeats(some)).collect())
    want = sorted((str(r["doc_id"]), plain_report(damaged_words(r["doc_id"], r["text"]))) for r in some.collect())
    assert got == want
    assert sum(r[1][0] > 0 for r in got) > 20


def test_find_runs_gives_texts(spark):
    df = spark.createDataFrame([(1, "go on \t" + "and on " * 6 + "then")], "doc_id long, text string")
    got = periodic.find_runs(df).first()
    assert (got["starts"], got["lengths"], got["periods"]) == ([1], [13], [2])
    assert got["collapsed"] == "go on and then"
