r"""Language-model scoring with a hashed maximum-entropy model (operator 8).

Tokens are a text's words (A-Z lower-cased) and one end token. A token's
probability is a product along its path in a tree of softmaxes. The
``classes * class_words`` most frequent tokens are cut by rank into classes:
P(class | context) P(token | class, context). All other words fall into tail
classes by a hash of their last letters, and below these the digits of the
word's own hash are drawn one after another, each given the digits before
it, so deep that a leaf holds about ``leaf_words`` distinct words at most; within a
leaf a word has its smoothed share of the leaf's counts.

Every softmax sums weight rows of hashed features of the words themselves
(64-bit hashes, whatever their frequency): for the class the word before and
the word before that (skip), below it the word before. The size of the
model follows the corpus: depth and leaves the distinct words counted, weight
rows the square root of the tokens counted (``Fit``). So do the tasks that
train, so what they send, rows times tasks, is in proportion to the tokens.

Training. Every training document is visited once, in ``rounds`` growing
shares by hash: each task runs Adagrad over its documents from the shared
weights and gives back how far each row moved, and the moves are averaged by
how often tasks touched the row. Moves are added up block by block in
streams, so no task holds more than its blocks of weights.

Counts cover all training words. Some ``local_words`` of the most frequent
are sent to the tasks (a bounded table; of equally frequent ones at its edge
a part by hash); the rest meet the counts in a shuffle join, as one row per
document and word.

Defined cases: null and empty texts are an end token alone; a null doc_id
hashes as the empty text; repeated rows are scored (and learned from) each;
without training documents the counts are zero and the model keeps its
starting weights; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_hash_mod, small_batches, stored

FOLDS = 10
#: No word has a space, so the end token can't clash with one.
END = " "
NEVER = -40.0
#: Weights are held between these, so that products of exps stay in range;
#: looked at every HOLD_STEPS steps (a step moves a weight by the rate at most
#: for each of its features).
FARTHEST = np.float32(20.0)
HOLD_STEPS = 16
#: Words longer than this are not sent to the tasks.
LOCAL_CHARS = 64
#: Tokens to a weight row while there are few.
ROW_TOKENS = 2
#: Weight rows and training tasks at most: some 0.3 GB of weights a worker.
MAX_BITS, MAX_TASKS = 20, 16_384


@dataclass(frozen=True)
class Shape:
    """``class_bits`` and ``word_bits`` are the least numbers of weight rows
    (as powers of two); ``class_words`` is a power of two."""

    classes: int = 32
    class_words: int = 64
    tail_classes: int = 16
    class_bits: int = 9
    word_bits: int = 9
    local_words: int = 131_072
    rounds: tuple[float, ...] = (0.125, 1.0)
    rate: float = 0.3
    batch: int = 8192

    @property
    def vocabulary(self) -> int:
        return self.classes * self.class_words

    @property
    def outcomes(self) -> int:
        return self.classes + self.tail_classes

    @property
    def leaf_words(self) -> int:
        return max(1, self.class_words // 2)

    @property
    def digit_bits(self) -> int:
        return self.class_words.bit_length() - 1


@dataclass(frozen=True)
class Fit:
    """Sizes that follow the corpus."""

    class_bits: int
    word_bits: int
    depth: int
    tasks: int
    batch: int  # tokens to a gradient step

    @staticmethod
    def of(shape: Shape, tokens: int, distinct: int) -> Fit:
        root = math.sqrt(max(1, tokens))
        rows = lambda least, scale: min(MAX_BITS, max(least, round(math.log2(max(1, min(
            tokens / ROW_TOKENS, max(scale * 4096, scale * root)))))))
        depth, leaves = 1, shape.tail_classes * shape.class_words
        while leaves * shape.leaf_words < distinct - shape.vocabulary:
            depth, leaves = depth + 1, leaves * shape.class_words
        return Fit(rows(shape.class_bits, 2), rows(shape.word_bits, 4), depth,
                   max(1, min(MAX_TASKS, round(root / 256))), min(shape.batch, max(64, tokens // 256)))


def tail_class(word: str, n: int) -> int:
    return zlib.crc32(word[-2:].encode()) % n


def words_of(texts: pa.Array):
    """(dictionary codes of all words in turn, distinct words, offsets)."""
    import pyarrow.compute as pc

    if texts.offset:  # pyarrow's ascii_lower misreads a slice
        texts = pa.array(texts.to_pylist(), pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    offsets = split.offsets.to_numpy()
    # Leading and trailing white space leaves empty pieces.
    if "" in distinct:
        real = codes != distinct.index("")
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        codes = codes[real]
    return codes, distinct, offsets


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over the texts of ``docs``, end tokens included. Tasks add
    up their own batches before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())],
                ["word", "n"])

        for batch in batches:
            codes, distinct, _ = words_of(batch.column("text"))
            counts = np.bincount(codes, minlength=len(distinct)).tolist()
            for word, n in zip(distinct, counts, strict=True):
                if n:
                    totals[word] = totals.get(word, 0) + n
            totals[END] = totals.get(END, 0) + batch.num_rows
            if len(totals) > 500_000:
                yield out()
                totals.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_keys(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, those of Spark's xxhash64."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)


#: The context of a document's first tokens; no word is two spaces.
START = word_keys(["  "])[0]


def path_of(word: str, depth: int, shape: Shape) -> Column:
    """A tail word's path number after ``depth`` digits, in Spark."""
    path = F.pmod(F.crc32(F.substring(word, -2, 2)), F.lit(shape.tail_classes)).cast("long")
    for k in range(depth):
        digit = F.shiftrightunsigned(F.xxhash64(word), shape.digit_bits * k).bitwiseAND(
            F.lit(shape.class_words - 1).cast("long"))
        path = path * shape.class_words + digit
    return path


@dataclass(frozen=True)
class Lexicon:
    """The local words as the model sees them, by place."""

    key: np.ndarray
    outcome: np.ndarray
    digit: np.ndarray  # of vocabulary words, -1 of others
    log_share: np.ndarray


@dataclass(frozen=True)
class Counts:
    """What the tasks know about counts."""

    local: dict[str, tuple[int, int]]  # word -> (place, count)
    lexicon: Lexicon
    tokens: int
    distinct: int
    fit: Fit
    class_totals: np.ndarray  # by outcome
    bias_counts: np.ndarray  # by node with a bias, and digit


def gather_counts(counts: DataFrame, shape: Shape) -> tuple[Counts, DataFrame]:
    """What the tasks are sent, and the table of leaves (leaf, tokens,
    distinct). ``counts`` is written down. The local words are the most
    frequent; of the last band of counts a part by hash, so that there are
    about ``shape.local_words``."""
    spark = counts.sparkSession
    tokens, distinct = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
    fit = Fit.of(shape, tokens, distinct)
    short = counts.where(F.length("word") <= LOCAL_CHARS).withColumn("band", F.floor(F.log2("n") * 8))
    room, edge, part = shape.local_words, -1, 1.0
    for r in sorted(short.groupBy("band").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["band"]):
        edge, part = r["band"], min(1.0, room / r["words"])
        room -= r["words"]
        if room <= 0:
            break
    wanted = (F.col("band") > edge) | ((F.col("band") == edge)
                                       & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(part * (1 << 20))))
    rows = sorted(short.where(wanted).select("word", "n").collect(), key=lambda r: (-r["n"], r["word"]))
    vocabulary = spark.createDataFrame([(r["word"],) for r in rows[:shape.vocabulary]], "word string")
    # At most shape.vocabulary short words.
    tail = counts.join(F.broadcast(vocabulary), "word", "left_anti")
    leaves = stored(tail.groupBy(path_of("word", fit.depth, shape).alias("leaf")).agg(
        F.sum("n").alias("tokens"), F.count("*").alias("distinct")), "lm-leaves")

    far = rows[shape.vocabulary:]
    local_leaf = spark.createDataFrame([(k, r["word"]) for k, r in enumerate(far)], "place long, word string")
    held = {r["place"]: (r["tokens"], r["distinct"]) for r in local_leaf.withColumn(
        "leaf", path_of("word", fit.depth, shape)).join(leaves, "leaf").collect()}
    share = [0.0] * min(len(rows), shape.vocabulary)
    share += [math.log10((r["n"] + 0.1) / (held[k][0] + 0.1 * (held[k][1] + 1))) for k, r in enumerate(far)]
    rank = np.arange(len(rows))
    known = rank < shape.vocabulary
    tails = np.array([tail_class(r["word"], shape.tail_classes) for r in rows], np.int64)
    lexicon = Lexicon(word_keys([r["word"] for r in rows]),
                      np.where(known, rank // shape.class_words, shape.classes + tails),
                      np.where(known, rank % shape.class_words, -1), np.array(share))

    head = np.zeros(shape.vocabulary)
    head[:min(len(rows), shape.vocabulary)] = [r["n"] for r in rows[:shape.vocabulary]]
    bias = [head.reshape(shape.classes, shape.class_words)]
    totals = np.zeros(shape.tail_classes)
    for level in range(1, min(fit.depth, 2) + 1):
        up = shape.class_words ** (fit.depth - level)
        sums = np.zeros(shape.tail_classes * shape.class_words ** level)
        for r in leaves.groupBy(F.floor(F.col("leaf") / up).alias("path")).agg(F.sum("tokens").alias("n")).collect():
            sums[r["path"]] = r["n"]
        bias.append(sums.reshape(-1, shape.class_words) + 0.5)
        totals = sums.reshape(shape.tail_classes, -1).sum(axis=1)
    # Nodes further down share a row of their own: no digit is likelier.
    bias.append(np.ones((1, shape.class_words)))
    return Counts({r["word"]: (k, r["n"]) for k, r in enumerate(rows)}, lexicon, tokens, distinct, fit,
                  np.concatenate((bias[0].sum(axis=1), totals + 1.0)), np.concatenate(bias)), leaves


ENCODED = ("row long, doc_id long, held_out boolean, share double, n_tokens long, n_local long, "
           "log_local double, words binary, far binary, deep array<struct<word:string,n:int>>")
#: What the model needs to know of a word that is not local.
FAR = np.dtype([("key", "<u8"), ("tail", "<u2")])
_DEEP = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))


def encode(docs: DataFrame, counts: Counts, shape: Shape) -> DataFrame:
    """Each row's tokens (``words``: places among the local words, and behind
    them among the row's other words), the sum of log10(count + 0.1) over its
    local words, and its other words, as hashes and tail classes (``far``)
    and with their numbers (``deep``)."""
    spark, tails = docs.sparkSession, shape.tail_classes
    shared = spark.sparkContext.broadcast(counts.local)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = shared.value
        end_place, end_n = local.get(END, (0, 0))
        for batch in batches:
            codes, distinct, offsets = words_of(batch.column("text"))
            got = list(map(local.get, distinct))
            n = np.array([g[1] if g else 0 for g in got], float)
            log_n = np.log10(n + 0.1)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            rows, size = batch.num_rows, np.diff(offsets) + 1
            deep = (n == 0)[codes]
            # Without any word, bincount counts in integers.
            log_local = np.bincount(doc[~deep], log_n[codes[~deep]], rows).astype(float)
            n_local = np.bincount(doc[~deep], minlength=rows)
            if end_n:
                log_local += np.log10(end_n + 0.1)
                n_local += 1
            pairs, back, times = np.unique(doc[deep] * max(1, len(distinct)) + codes[deep],
                                           return_inverse=True, return_counts=True)
            of, word = np.divmod(pairs, max(1, len(distinct)))
            starts = np.searchsorted(of, np.arange(rows + 1)).astype(np.int32)
            place = np.array([g[0] if g else 0 for g in got], "<u4")[codes]
            place[deep] = len(local) + back - starts[doc[deep]]
            end_at = np.full(rows, end_place) if end_n else len(local) + np.diff(starts)
            packed = [_squeeze(np.append(place[a:b], np.array([e], "<u4")))
                      for a, b, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), end_at.tolist(), strict=True)]
            # Hashes and tail classes of the deep words, each found once.
            need, at = np.unique(word, return_inverse=True)
            found = np.empty(len(need), FAR)
            found["key"] = word_keys([distinct[k] for k in need.tolist()])
            found["tail"] = [tail_class(distinct[k], tails) for k in need.tolist()]
            found = found[at]
            far = [found[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            words = pa.array(distinct, pa.string()).take(pa.array(word, pa.int64()))
            deep_rows = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays(
                [words, pa.array(times, pa.int32())], ["word", "n"]))
            if not end_n:  # no training document: the end token is unknown
                deep_rows = pa.array([(d or []) + [{"word": END, "n": 1}] for d in deep_rows.to_pylist()], _DEEP)
                end = np.array([(word_keys([END])[0], tail_class(END, tails))], FAR).tobytes()
                far = [f + end for f in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
                 batch.column("share"), pa.array(size.astype(np.int64)), pa.array(n_local.astype(np.int64)),
                 pa.array(log_local), pa.array(packed, pa.binary()), pa.array(far, pa.binary()), deep_rows],
                ["row", "doc_id", "held_out", "share", "n_tokens", "n_local", "log_local", "words", "far", "deep"])

    return (docs.select(F.monotonically_increasing_id().alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"),
                        (id_hash_mod("doc_id", FOLDS) == 0).alias("held_out"),
                        (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)).alias("share"),
                        "text").mapInArrow(run, ENCODED))


def _squeeze(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, and compressed."""
    raw = numbers.astype(numbers.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _expand(data: bytes, kind: str) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    parts = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(parts.T).view(kind).ravel()


def _read(words: pa.Array, far: pa.Array, lexicon: Lexicon, shape: Shape) -> tuple[Stream, np.ndarray]:
    """The rows' tokens in turn, and the sum of each row's local words' log10
    shares of their leaves."""
    places = [_expand(packed, "<u4") for packed in words.to_pylist()]
    others = [np.frombuffer(x or b"", FAR) for x in far.to_pylist()]
    n, rows = len(lexicon.key), len(places)
    size, more = (np.array(list(map(len, x)), np.int64) for x in (places, others))
    place, other = (np.concatenate(x) if rows else np.empty(0, kind)
                    for x, kind in ((places, "<u4"), (others, FAR)))
    place, doc = place.astype(np.int64), np.repeat(np.arange(rows), size)
    inside = place < n
    local, outside = place[inside], np.flatnonzero(~inside)
    key, outcome = np.empty(len(place), np.uint64), np.empty(len(place), np.int64)
    digit = np.full(len(place), -1)
    key[inside], outcome[inside], digit[inside] = lexicon.key[local], lexicon.outcome[local], lexicon.digit[local]
    if len(outside):
        behind = place[outside] - n + (np.cumsum(more) - more)[doc[outside]]
        key[outside], outcome[outside] = other["key"][behind], shape.classes + other["tail"][behind]
    shares = np.bincount(doc[inside], lexicon.log_share[local], rows).astype(float)
    return Stream(key, outcome, digit, size), shares


@dataclass(frozen=True)
class Stream:
    """Tokens of some rows, one after another, and how many each row has."""

    key: np.ndarray
    outcome: np.ndarray
    digit: np.ndarray
    size: np.ndarray

    def groups(self) -> Iterator[Stream]:
        """Rows in turn, of about GROUP_TOKENS together."""
        ends = np.cumsum(self.size)
        a = begin = 0
        while a < len(ends):
            b = min(int(np.searchsorted(ends, begin + GROUP_TOKENS)) + 1, len(ends))
            s = slice(begin, int(ends[b - 1]))
            yield Stream(self.key[s], self.outcome[s], self.digit[s], self.size[a:b])
            a, begin = b, s.stop


class Weights:
    """Class and word weight rows, flat in one float32 array."""

    def __init__(self, shape: Shape, fit: Fit, flat: np.ndarray):
        self.shape, self.fit, self.flat = shape, fit, flat
        c, w = (1 << fit.class_bits) * shape.outcomes, (1 << fit.word_bits) * shape.class_words
        self.by_class = flat[:c].reshape(-1, shape.outcomes)
        self.by_word = flat[c:c + w].reshape(-1, shape.class_words)
        self.class_bias = flat[c + w:c + w + shape.outcomes]
        self.word_bias = flat[c + w + shape.outcomes:].reshape(-1, shape.class_words)

    def exponentials(self) -> Weights:
        flat, rows = self.flat.copy(), self.by_class.size + self.by_word.size
        np.clip(flat[:rows], -FARTHEST, FARTHEST, out=flat[:rows])
        return Weights(self.shape, self.fit, np.exp(flat, out=flat))

    @staticmethod
    def start(shape: Shape, counts: Counts) -> Weights:
        """Zero rows; biases at the log shares of classes and digits."""
        total, below = counts.class_totals, counts.bias_counts
        with np.errstate(divide="ignore", invalid="ignore"):
            class_bias = np.where(total > 0, np.log(total / total.sum()), NEVER)
            word_bias = np.where(below > 0, np.log(below / below.sum(axis=1, keepdims=True)), NEVER)
        rows = ((1 << counts.fit.class_bits) * shape.outcomes + (1 << counts.fit.word_bits) * shape.class_words)
        return Weights(shape, counts.fit, np.concatenate(
            (np.zeros(rows), class_bias, word_bias.ravel())).astype(np.float32))


def _mix(x: np.ndarray, kind: int, bits: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Tokens:
    """Tokens of some documents with their hashed context features. The
    softmaxes below the class are listed one by one: of which token, at which
    bias row, for which digit."""

    doc: np.ndarray
    outcome: np.ndarray
    class_rows: list[np.ndarray]
    word_at: np.ndarray
    word_node: np.ndarray
    word_digit: np.ndarray
    word_rows: list[np.ndarray]

    @staticmethod
    def of(docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], shape: Shape, fit: Fit) -> Tokens:
        """Of documents' (keys, outcomes, digits)."""
        size = np.array([len(d[0]) for d in docs], np.int64)
        return Tokens.of_stream(Stream(*(np.concatenate(x) for x in zip(*docs, strict=True)), size), shape, fit)

    @staticmethod
    def of_stream(stream: Stream, shape: Shape, fit: Fit) -> Tokens:
        key, outcome, digit, size = stream.key, stream.outcome, stream.digit, stream.size
        doc = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
        before = np.where(place >= 1, np.roll(key, 1), START)
        skip = np.where(place >= 2, np.roll(key, 2), START)
        odd = np.uint64(0xD6E8FEB86659FD93)
        contexts = (before, skip ^ odd)
        head = np.flatnonzero(digit >= 0)
        at, node, digits = [head], [outcome[head]], [digit[head]]
        tail = np.flatnonzero(digit < 0)
        path, first, wide = outcome[tail] - shape.classes, shape.classes, shape.tail_classes
        for k in range(fit.depth):
            d = ((key[tail] >> np.uint64(shape.digit_bits * k)) & np.uint64(shape.class_words - 1)).astype(np.int64)
            at.append(tail)
            node.append(first + path)
            digits.append(d)
            path, first, wide = path * shape.class_words + d, first + wide, wide * shape.class_words
        at, node = np.concatenate(at), np.concatenate(node)
        mine = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB)
        return Tokens(doc, outcome, [_mix(c, 0, fit.class_bits) for c in contexts], at, node,
                      np.concatenate(digits), [_mix(c[at] ^ mine, 1, fit.word_bits) for c in contexts[:1]])


#: Rows of a softmax at once, so that they stay in a core's cache.
SOFTMAX_ROWS = 512


class Softmax:
    """Softmaxes over sums of weight rows and a bias row. The rows' exponentials
    are kept and multiplied, so that exp is taken of moves and not of every
    token's sum."""

    def __init__(self, exps: np.ndarray, bias: np.ndarray):
        self.exps, self.bias, width = exps, bias, exps.shape[1]
        self.block, self.spare = (np.empty((SOFTMAX_ROWS, width), np.float32) for _ in range(2))
        self.ones, self.out = np.ones(width, np.float32), np.empty((0, width), np.float32)
        # The rows, each as one element.
        self.whole = exps.view(np.dtype((np.void, exps.itemsize * width))).reshape(-1)

    def _products(self, rows: list[np.ndarray], node: np.ndarray | None, z: np.ndarray) -> None:
        """Row numbers are in range: clipping them only spares a buffer."""
        spare = self.spare[:len(z)]
        self.exps.take(rows[0], axis=0, out=z, mode="clip")
        for r in rows[1:]:
            z *= self.exps.take(r, axis=0, out=spare, mode="clip")
        z *= self.bias if node is None else self.bias.take(node, axis=0, out=spare, mode="clip")

    def probabilities(self, rows: list[np.ndarray], node: np.ndarray | None) -> np.ndarray:
        """One row each, valid until the next call. ``node``: bias rows (past
        the last: the last)."""
        n = len(rows[0])
        if len(self.out) < n:
            self.out = np.empty((n, len(self.ones)), np.float32)
        for k in range(0, n, SOFTMAX_ROWS):
            s = slice(k, min(k + SOFTMAX_ROWS, n))
            z = self.out[s]
            self._products([r[s] for r in rows], None if node is None else node[s], z)
            z *= np.reciprocal(z @ self.ones)[:, None]
        return self.out[:n]

    def log_of(self, rows: list[np.ndarray], node: np.ndarray | None, target: np.ndarray) -> np.ndarray:
        """log10 of each target's probability, at least -30."""
        n = len(target)
        out, place = np.empty(n), np.arange(SOFTMAX_ROWS)
        for k in range(0, n, SOFTMAX_ROWS):
            s = slice(k, min(k + SOFTMAX_ROWS, n))
            z = self.block[:s.stop - k]
            self._products([r[s] for r in rows], None if node is None else node[s], z)
            out[s] = z[place[:len(z)], target[s]] / (z @ self.ones)
        return np.log10(np.maximum(out, 1e-30, out=out), out=out)

    def move(self, at: np.ndarray, by: np.ndarray) -> None:
        """Takes ``by`` (overwritten) from the weights of the rows ``at``, each
        named once."""
        np.exp(np.negative(by, out=by), out=by)
        by *= self.exps.take(at, axis=0)
        self.whole.put(at, by.view(self.whole.dtype).reshape(-1))

    def hold(self) -> None:
        np.clip(self.exps, np.exp(-FARTHEST), np.exp(FARTHEST), out=self.exps)


def softmaxes(e: Weights) -> tuple[Softmax, Softmax]:
    """Of the exponentials of weights: class and word."""
    return Softmax(e.by_class, e.class_bias), Softmax(e.by_word, e.word_bias)


def log_probabilities(t: Tokens, w: Weights) -> np.ndarray:
    """log10 of the product of each token's softmaxes."""
    return _log_probabilities(t, softmaxes(w.exponentials()))


def _log_probabilities(t: Tokens, pair: tuple[Softmax, Softmax]) -> np.ndarray:
    out = pair[0].log_of(t.class_rows, None, t.outcome)
    below = pair[1].log_of(t.word_rows, t.word_node, t.word_digit)
    return out + np.bincount(t.word_at, below, len(out))


#: Stretches from here on are summed one by one.
LONG_STRETCH = 8
_ONES = np.ones(1 << 14, np.float32)


def _stretch_sums(rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the first n[0] rows, the next n[1], and so on (each over 0):
    long stretches one by one, of short ones all first rows, all second rows
    and so on."""
    out, begin, long = np.empty((len(n), rows.shape[1]), np.float32), np.cumsum(n) - n, n > LONG_STRETCH
    ones = _ONES if len(rows) <= len(_ONES) else np.ones(len(rows), np.float32)
    which = np.flatnonzero(long)
    for k, a, size in zip(which.tolist(), begin[which].tolist(), n[which].tolist(), strict=True):
        np.dot(ones[:size], rows[a:a + size], out=out[k])
    short = np.flatnonzero(~long)
    short = short[np.argsort(-n[short], kind="stable")]
    at, sizes = begin[short], n[short]
    sums = rows.take(at, axis=0)
    for k in range(1, int(sizes[0]) if len(sizes) else 0):
        still = int(np.searchsorted(-sizes, -k, "left"))
        sums[:still] += rows.take(at[:still] + k, axis=0)
    out[short] = sums
    return out


class Learner:
    """Adagrad on the rows of one task, from the weights ``w``; counts how often
    it touched each."""

    def __init__(self, w: Weights):
        self.w, self.shape, self.steps = w, w.shape, 0
        self.softmax = softmaxes(w.exponentials())
        self.seen = [np.zeros(len(t), np.float32) for t in (w.by_class, w.by_word)]
        self.squares = [np.full(len(t), 1e-2, np.float32) for t in (w.by_class, w.by_word)]

    def _step(self, k: int, rows: list[np.ndarray], node: np.ndarray | None, target: np.ndarray) -> None:
        """Rows move along their mean gradient, often-touched rows by more."""
        softmax = self.softmax[k]
        self.steps += 1
        if self.steps % HOLD_STEPS == 0:
            for x in self.softmax:
                x.hold()
        g = softmax.probabilities(rows, node)
        g[np.arange(len(g)), target] -= 1
        squares, seen, rate = self.squares[k], self.seen[k], np.float32(self.shape.rate)
        for r in rows:
            # Sixteen bits are sorted by digits.
            order = np.argsort(r.astype(np.uint16) if len(squares) <= 1 << 16 else r, kind="stable")
            r = r[order]
            first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            times = np.diff(np.append(first, len(r)))
            once = times == 1
            one = order[first[once]]
            at = r[first[once]]
            move = g.take(one, axis=0)
            squares[at] += np.einsum("ij,ij->i", move, move)
            move *= (rate / np.sqrt(squares[at]))[:, None]
            softmax.move(at, move)
            seen[at] += 1
            if len(one) < len(first):
                n, at = times[~once], r[first[~once]]
                many = order[np.repeat(~once, times)]
                move = _stretch_sums(g.take(many, axis=0), n)
                move /= np.sqrt(n, dtype=np.float32)[:, None]
                squares[at] += np.einsum("ij,ij->i", move, move)
                move *= (rate / np.sqrt(squares[at]))[:, None]
                softmax.move(at, move)
                seen[at] += n

    def learn(self, t: Tokens) -> None:
        step = self.w.fit.batch
        for k in range(0, len(t.outcome), step):
            s = slice(k, k + step)
            self._step(0, [r[s] for r in t.class_rows], None, t.outcome[s])
        for k in range(0, len(t.word_at), step):
            s = slice(k, k + step)
            self._step(1, [r[s] for r in t.word_rows], t.word_node[s], t.word_digit[s])

    def moved(self, k: int, rows: slice) -> np.ndarray:
        """How far the weights of these rows have moved."""
        old = (self.w.by_class, self.w.by_word)[k][rows]
        return np.where((self.seen[k][rows] > 0)[:, None], np.log(self.softmax[k].exps[rows]) - old, 0)


#: Rows of weights in one block of moves, at most.
BLOCK_ROWS = 512
#: Tokens that a task turns into features at once.
GROUP_TOKENS = 1 << 18

MOVES = "block int, seen binary, moved binary"


def train_round(encoded: DataFrame, w: Weights, counts: Counts) -> Weights:
    """One round over the documents of ``encoded``."""
    spark = encoded.sparkSession
    shape, fit = w.shape, w.fit
    shared = spark.sparkContext.broadcast(w.flat)
    lexicon = spark.sparkContext.broadcast(counts.lexicon)
    class_blocks = (1 << fit.class_bits) // BLOCK_ROWS
    blocks = class_blocks + (1 << fit.word_bits) // BLOCK_ROWS

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(Weights(shape, fit, shared.value))
        for batch in batches:
            stream, _ = _read(batch.column("words"), batch.column("far"), lexicon.value, shape)
            for group in stream.groups():
                learner.learn(Tokens.of_stream(group, shape, fit))
        for b in range(blocks):
            k, at = (0, b) if b < class_blocks else (1, b - class_blocks)
            s = slice(at * BLOCK_ROWS, (at + 1) * BLOCK_ROWS)
            seen = learner.seen[k][s]
            if seen.any():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([b], pa.int32()), "seen": [seen.tobytes()],
                    "moved": [learner.moved(k, s).astype(np.float16).tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for b, seen, moved in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                seen = np.frombuffer(seen, np.float32)
                moved = np.frombuffer(moved, np.float16).astype(np.float32).reshape(BLOCK_ROWS, -1)
                if b not in sums:
                    sums[b] = [np.zeros(BLOCK_ROWS, np.float32), np.zeros_like(moved)]
                sums[b][0] += seen
                sums[b][1] += seen[:, None] * moved
        for b, (seen, moved) in sums.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([b], pa.int32()), "seen": [seen.tobytes()],
                "moved": [(moved / np.maximum(seen, 1)[:, None]).astype(np.float32).tobytes()]})

    moves = (encoded.select("words", "far").coalesce(fit.tasks).mapInArrow(learn, MOVES)
             .repartition(blocks, "block").mapInArrow(add, MOVES))
    out = Weights(shape, fit, w.flat.copy())
    for r in moves.collect():  # one row per block of the model
        k, at = (0, r["block"]) if r["block"] < class_blocks else (1, r["block"] - class_blocks)
        moved = np.frombuffer(r["moved"], np.float32).reshape(BLOCK_ROWS, -1)
        (out.by_class, out.by_word)[k][at * BLOCK_ROWS:(at + 1) * BLOCK_ROWS] += moved
    return out


def model_scores(encoded: DataFrame, w: Weights, counts: Counts) -> DataFrame:
    """Rows with ``model``: log10 of their tokens' softmaxes, and of the leaf
    shares of their local words. Their other words (``deep``) stay where they
    are written."""
    spark, encoded = encoded.sparkSession, encoded.drop("deep")
    shape, fit = w.shape, w.fit
    shared = spark.sparkContext.broadcast(w.exponentials().flat)
    lexicon = spark.sparkContext.broadcast(counts.lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = softmaxes(Weights(shape, fit, shared.value))
        for batch in batches:
            stream, shares = _read(batch.column("words"), batch.column("far"), lexicon.value, shape)
            scores = [np.bincount(t.doc, _log_probabilities(t, pair), len(group.size))
                      for group in stream.groups() for t in [Tokens.of_stream(group, shape, fit)]]
            model = pa.array(np.concatenate([*scores, np.empty(0)]) + shares, pa.float64())
            keep = [k for k, name in enumerate(batch.schema.names) if name not in ("words", "far")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), model], [*(batch.schema.names[k] for k in keep), "model"])

    fields = ", ".join(f"{n} {t}" for n, t in encoded.dtypes if n not in ("words", "far"))
    return encoded.mapInArrow(score, f"{fields}, model double")


def train(encoded: DataFrame, counts: Counts, shape: Shape) -> Weights:
    w, begin = Weights.start(shape, counts), 0.0
    for upto in shape.rounds:
        w = train_round(encoded.where(~F.col("held_out") & (F.col("share") >= begin)
                                      & (F.col("share") < upto)), w, counts)
        begin = upto
    return w


def language_model_report(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    small_batches(docs.sparkSession, 2000)
    docs = docs.select("doc_id", "text")
    counts = stored(count_words(docs.where(id_hash_mod("doc_id", FOLDS) != 0)), "lm-counts")
    known, leaves = gather_counts(counts, shape)
    encoded = stored(encode(docs, known, shape), "lm-encoded")
    weights = train(encoded, known, shape)
    scored = stored(model_scores(encoded, weights, known), "lm-scored")
    # The other words meet the counts, and their leaves, in joins.
    times, n = F.col("times"), F.coalesce("n", F.lit(0))
    share = (n + F.lit(0.1)) / (F.coalesce("tokens", F.lit(0)) + F.lit(0.1) * (F.coalesce("distinct", F.lit(0)) + 1))
    deep = (encoded.select("row", F.inline("deep")).withColumnRenamed("n", "times")
            .join(counts, "word", "left").withColumn("leaf", path_of("word", known.fit.depth, shape))
            .join(leaves, "leaf", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("n").isNotNull(), times).otherwise(0)).alias("deep_known"),
                F.sum(times * F.log10(n + F.lit(0.1))).alias("log_deep"),
                F.sum(times * F.log10(share)).alias("deep_shares")))
    none = F.lit(0.0)
    base = float(np.log10(known.tokens + 0.1 * (known.distinct + 1)))
    return (scored.join(deep, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_local") + F.coalesce("deep_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("log_local") + F.coalesce("log_deep", none) - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model") + F.coalesce("deep_shares", none)).alias("score")))
