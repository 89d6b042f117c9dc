import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import toxicity
from tests.llm.conftest import prose

HOW = toxicity.Training(documents=400, steps=60)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(500):
        toxic = i % 4 == 0
        text = prose(rng, rng.randint(10, 120))
        if toxic:
            bad = [f"grumm{rng.choice('aeiou')}x{rng.randrange(50)}" for _ in range(3)]
            text = " ".join(sorted(text.split() + bad, key=lambda _: rng.random()))
        rows.append((i, text, int(toxic)))
    return rows


def test_held_out_accuracy(spark, corpus):
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t, _ in corpus], "doc_id long, text string, score string, toxicity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, labels, HOW).collect()}
    assert len(got) == len(corpus)
    for i, _, _ in corpus:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in corpus if got[i].held_out]
    assert np.mean([p == y for p, y in held]) >= 0.97


def test_held_out_labels_are_not_learned_from(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus], "doc_id long, text string")
    labels = lambda flip: spark.createDataFrame(
        [(i, 1 - y if flip and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in corpus],
        "doc_id long, toxic int")
    a, b = (sorted(map(tuple, toxicity.toxicity_report(docs, labels(f), HOW).collect())) for f in (0, 1))
    assert a == b


def test_batch_scores_equal_one_by_one(corpus):
    texts = [t for _, t, _ in corpus[:40]] + [None, "", "  ", "Ü x", "a" * 100_000]
    model = toxicity.fit(pa.array(texts), np.arange(len(texts)) % 2, HOW)
    together = model.score(pa.array(texts))
    alone = [model.score(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(together, alone)
    assert np.allclose(model.score(pa.array(["skip", *texts])[1:]), together)


def test_edges(spark, docs, empty, rows):
    labels = spark.createDataFrame([(20, 1), (20, 0), (21, None), (None, 1), (77, 1), (100, 0), (101, 0)],
                                   "doc_id long, toxic int")
    assert toxicity.toxicity_report(docs, labels, HOW).count() == len(rows)
    none = toxicity.toxicity_report(docs, labels.limit(0), HOW).collect()
    assert len({r.score for r in none}) == 1 and none[0].predicted == 0
    assert toxicity.toxicity_report(empty, labels, HOW).count() == 0


def test_repeated_rows_are_learned_from_once(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % toxicity.FOLDS]
    rows = [(i, f"text {i}") for i in ids[:20]] + [(ids[0], "text again")] + [(ids[1], "text 1x")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids[:20]], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels, toxicity.Training()).collect()
    assert len(got) == 22 and len({r.text for r in got}) == 22
