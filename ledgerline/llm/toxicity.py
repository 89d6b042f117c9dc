r"""Toxicity: a character n-gram linear classifier (operator 2).

Features are the character n-grams of a text's distinct words, each word
with a space at either end, hashed into ``2 ** bits`` columns; a column's
value is the number of distinct words that have the n-gram. Columns are
scaled by naive Bayes log-count ratios and a logistic regression is trained
on the scaled columns. The classifier is linear, so a text's score is the
bias plus the sum of its distinct words' weights, and a batch of texts is
scored from its dictionary of words.

Training uses a bounded sample of the labelled documents
(``Training.documents`` with the smallest id hashes); every document is
scored, over its whole text.

Defined cases: null and empty texts have no words and score by the bias;
rows with a null label, and labels whose document is missing, are not
learned from; of several labels of a document the highest counts; repeated
rows are scored each; without both labels in the sample every score is the
share of the label; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_hash_mod, small_batches

#: Ids whose crc32 leaves remainder 0 by this are held out.
FOLDS = 5


@dataclass(frozen=True)
class Training:
    documents: int = 10_000
    bits: int = 18
    sizes: tuple[int, ...] = (3, 4, 5)
    smoothing: float = 10.0
    penalty: float = 3e-3
    steps: int = 120
    rate: float = 0.05


@dataclass(frozen=True)
class Model:
    bits: int
    sizes: tuple[int, ...]
    bias: float
    weights: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        doc, word, chars, ends = distinct_words(texts)
        per_word = np.zeros(len(ends))
        for at, column in ngrams(chars, ends, self.sizes, self.bits):
            per_word += np.bincount(at, self.weights[column], len(ends))
        z = self.bias + np.bincount(doc, per_word[word], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, word) index pairs without repeats; all words' characters laid
    end to end, each word padded by spaces; and each word's end there."""
    import pyarrow.compute as pc

    texts = pc.fill_null(pa.concat_arrays([texts]).cast(pa.large_string()), "")
    if texts.offset:
        texts = pa.array(texts.to_pylist(), pa.large_string())
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    coded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy()
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    pairs = np.unique(doc * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False))
    doc, word = np.divmod(pairs, max(1, len(coded.dictionary)))
    padded = [f" {w} " for w in coded.dictionary.to_pylist()]
    chars = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, padded), np.int64, len(padded)))
    return doc, word, chars, ends


def ngrams(chars: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...],
           bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, (word, hashed column) of every n-gram in a word."""
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    word_of = np.repeat(np.arange(len(ends)), ends - starts)
    rolled = np.zeros(len(chars), np.uint64)
    for k in range(max(sizes)):
        # rolled[i]: hash of chars[i : i + k + 1]
        rolled = rolled[:len(chars) - k] * np.uint64(0x9E3779B97F4A7C15) + chars[k:] + np.uint64(1)
        n = k + 1
        if n in sizes and len(rolled):
            inside = word_of[:len(rolled)] == word_of[k:]
            mixed = rolled[inside] ^ (rolled[inside] >> np.uint64(29))
            yield (word_of[:len(rolled)][inside],
                   (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64))


def fit(texts: pa.Array, toxic: np.ndarray, how: Training = Training()) -> Model:
    """Log-count ratios, then logistic regression on the scaled columns."""
    n, y = len(texts), toxic.astype(float)
    width = 1 << how.bits
    if not 0 < y.sum() < n:
        share = (y.sum() + 0.5) / (n + 1) if n else 0.0
        return Model(how.bits, how.sizes, float(np.log(max(share, 1e-9) / (1 - min(share, 1 - 1e-9)))),
                     np.zeros(width))
    doc, word, chars, ends = distinct_words(texts)
    grams = [*ngrams(chars, ends, how.sizes, how.bits)]
    at, column = (np.concatenate(x) for x in zip(*grams, strict=True))

    def by_column(per_doc: np.ndarray) -> np.ndarray:
        per_word = np.bincount(word, per_doc[doc], len(ends))
        return np.bincount(column, per_word[at], width)

    def by_doc(weights: np.ndarray) -> np.ndarray:
        return np.bincount(doc, np.bincount(at, weights[column], len(ends))[word], n)

    for_, against = by_column(y), by_column(1 - y)
    share = for_.sum() / (for_.sum() + against.sum())
    a, b = for_ + how.smoothing * share, against + how.smoothing * (1 - share)
    ratio = np.log(a / a.sum()) - np.log(b / b.sum())
    # Adam on the mean log loss; the bias starts at the prior.
    w, bias = np.zeros(width), np.log(y.mean() / (1 - y.mean()))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, how.steps + 1):
        error = 1 / (1 + np.exp(-np.clip(by_doc(w * ratio) + bias, -500, 500))) - y
        g, gb = by_column(error) * ratio / n + how.penalty * w, error.mean()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = how.rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb) + 1e-8)
    return Model(how.bits, how.sizes, float(bias), w * ratio)


def training_rows(docs: DataFrame, labels: DataFrame, how: Training) -> DataFrame:
    """(text, toxic) of the sample: labelled ids outside the held-out fold,
    those of the smallest hashes. Ids are chosen on the labels alone; their
    table, ``how.documents`` rows at most, is broadcast to the texts. Equal
    rows of a document count once."""
    ids = (labels.where((id_hash_mod("doc_id", FOLDS) != 0) & F.col("toxic").isNotNull()
                        & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.documents))
    return (docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic").distinct()
            .select("text", "toxic"))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Fit on the bounded sample, in one task; the model comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [*batches]
        texts = pa.concat_arrays([b.column("text").cast(pa.large_string()) for b in got]) if got else pa.array([], pa.string())
        toxic = np.concatenate([b.column("toxic").to_numpy(zero_copy_only=False) for b in got] or [[]])
        model = fit(texts, toxic > 0, how)
        yield pa.RecordBatch.from_pydict({"bias": [model.bias],
                                          "weights": [model.weights.astype("<f4").tobytes()]})

    small_batches(docs.sparkSession)
    row = (training_rows(docs, labels, how).coalesce(1)
           .mapInArrow(run, "bias double, weights binary").first())
    if row is None:  # an empty table may have no task at all
        return fit(pa.array([], pa.string()), np.zeros(0), how)
    return Model(how.bits, how.sizes, row["bias"], np.frombuffer(row["weights"], "<f4").astype(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and toxicity (0 to 1) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    # 2 ** bits weights
    shared = spark.sparkContext.broadcast((model.bits, model.sizes, model.bias, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(batch.column("text")))],
                ["doc_id", "toxicity"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, toxicity double"))


def toxicity_report(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = docs.select("doc_id", "text")
    found = scored(docs, train(docs, labels.select("doc_id", "toxic"), how))
    return found.select("doc_id", (id_hash_mod("doc_id", FOLDS) == 0).alias("held_out"),
                        F.col("toxicity").alias("score"),
                        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
