"""Periodic run detection (operator 12).

A run is a stretch of words with smallest period q and a length of at least
``max(MIN_WORDS, MIN_EXPONENT * q)`` that no neighbouring word extends.

Internal pattern matching, for all documents of a batch at once:

1. Words become numbers. A word position is *active* while the block of
   ``m`` words that starts there occurs again in its document; doubling
   ``m`` from ``FIRST_BLOCK`` on, only active positions are sorted again
   (by the pair of their block's and the following block's rank), until the
   order is a suffix array of them. Each round leaves every block's interval
   in that array.
2. A wavelet tree over the suffix array answers range successor queries:
   the smallest text position in an interval that is past a given one.
3. Dyadic blocks of ``m`` words at every multiple of ``m / 2`` ask for their
   next occurrence in the neighbouring window of ``m`` words. Occurrences of
   a block in such a window form a progression; its difference ``q`` is a
   candidate period, and blocks with one ``q`` in one stretch are one
   candidate.
4. A candidate is extended to both sides as far as words ``q`` apart agree.

Every run is found: it is longer than 4 q words, so for the power of two
``m`` in [q, 2q) (or 4) it holds a block that is repeated q words on inside
it, and no nearer, since q words of the run in a row are primitive. By the
same argument what is found has q as its smallest period.

Documents are independent: nothing is shuffled, and a task holds one batch
of texts.

Defined cases: a null, empty or blank text has no words; rows that repeat a
doc_id are separate documents; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches

MIN_WORDS = 6
MIN_EXPONENT = 4
#: Words of the shortest block; of a shorter one a run of six words need not
#: hold more than a block of four does.
FIRST_BLOCK = 4
#: Text bytes that are searched at once in a task.
BATCH_BYTES = 4 << 20

RUNS_SCHEMA = ("doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, "
               "collapsed string")


class WaveletTree:
    """Numbers below 2 ** bits in a row; one bit level at a time, zeros
    stably before ones. ``zeros[k][i]``: zeros among the first i at level k."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for k in range(self.bits - 1, -1, -1):
            zero = (values >> k) & 1 == 0
            counts = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=counts[1:])
            self.zeros.append(counts)
            values = np.concatenate((values[zero], values[~zero]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are less than x."""
        n = np.where(x >= 1 << self.bits, hi - lo, 0)
        live = x < 1 << self.bits
        lo, hi = np.where(live, lo, 0), np.where(live, hi, 0)
        for k, counts in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            lo0, hi0, total = counts[lo], counts[hi], counts[-1]
            one = (x >> k) & 1 == 1
            n = n + np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, total + lo - lo0, lo0), np.where(one, total + hi - hi0, hi0)
        return n

    def smallest(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest (from 0) of values[lo:hi]; nth < hi - lo."""
        out = np.zeros(len(lo), np.int64)
        for k, counts in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            lo0, hi0, total = counts[lo], counts[hi], counts[-1]
            one = nth >= hi0 - lo0
            nth = np.where(one, nth - (hi0 - lo0), nth)
            out |= one.astype(np.int64) << k
            lo, hi = np.where(one, total + lo - lo0, lo0), np.where(one, total + hi - hi0, hi0)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest of values[lo:hi] that is x or more, -1 if none."""
        n = self.below(lo, hi, x)
        found = n < hi - lo
        out = np.full(len(lo), -1, np.int64)
        out[found] = self.smallest(lo[found], hi[found], n[found])
        return out


def _repeated(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions (ascending) whose first block may occur again in the same
    document: equal hashes, so some others slip in, none is missed."""
    n = len(words) - FIRST_BLOCK + 1
    if n < 2:
        return np.empty(0, np.int64)
    key = doc[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(FIRST_BLOCK):
        key = (key ^ words[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(np.arange(n) + FIRST_BLOCK <= end[:n])
    key = key[at]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    active = np.zeros(len(at), bool)
    active[order[1:][same]] = True
    active[order[:-1][same]] = True
    return at[active]


def _groups(new: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, size) of each one's group; ``new`` marks group starts."""
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(new)))
    return np.repeat(slots[first], sizes), np.repeat(sizes, sizes)


def candidates(words: np.ndarray, doc: np.ndarray, begin: np.ndarray,
               end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of dyadic blocks whose next occurrence lies in the
    neighbouring window. ``begin`` and ``end``: of each word's document."""
    at = _repeated(words, doc, end)
    none = np.empty(0, np.int64)
    if not len(at):
        return none, none
    # Order and ranks of the first blocks; a rank is its group's first slot.
    keys = [words[at + k] for k in range(FIRST_BLOCK - 1, -1, -1)] + [doc[at]]
    order = np.lexsort(keys)
    new = np.ones(len(at), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    slots = np.arange(len(at))
    first, size = _groups(new, slots)
    rank, sizes = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    rank[order], sizes[order] = first, size
    inside = at - begin[at]
    room = end[at] - at
    m, asked = FIRST_BLOCK, []
    while True:
        live = sizes > 1
        if not live.any():
            break
        block = np.flatnonzero(live & (inside % (m // 2) == 0))
        asked.append((block, rank[block], rank[block] + sizes[block], np.full(len(block), m)))
        # Blocks of 2 m words: the following block's rank, or a number of
        # its own where that occurs once or the document ends.
        some = np.flatnonzero(live)
        follow = np.searchsorted(at, at[some] + m)
        follow[follow == len(at)] = 0
        known = (at[follow] == at[some] + m) & (room[some] >= 2 * m) & live[follow]
        second = np.where(known, rank[follow], len(at) + some)
        by = np.lexsort((second, rank[some]))
        some, second = some[by], second[by]
        slots = np.sort(rank[some], kind="stable")
        starts = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
        slots = slots + np.arange(len(slots)) - np.repeat(starts, np.diff(np.append(starts, len(slots))))
        new = np.ones(len(some), bool)
        new[1:] = (rank[some[1:]] != rank[some[:-1]]) | (second[1:] != second[:-1])
        first, size = _groups(new, slots)
        order[slots] = some
        sizes = np.zeros(len(at), np.int64)
        rank[some], sizes[some] = first, size
        m *= 2
    if not asked:
        return none, none
    block, lo, hi, length = (np.concatenate(x) for x in zip(*asked, strict=True))
    found = WaveletTree(order.astype(np.int64)).successor(lo, hi, block + 1)
    block, length, found = block[found >= 0], length[found >= 0], found[found >= 0]
    position, period = at[block], at[found] - at[block]
    near = period <= length
    return position[near], period[near]


def _agreeing(words: np.ndarray, at: int, period: int, begin: int, end: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words agree ``period`` apart, as the
    run's start and end."""
    right, n = at, 32
    while right < end - period:
        n = min(2 * n, end - period - right)
        same = words[right:right + n] == words[right + period:right + period + n]
        if not same.all():
            right += int(same.argmin())
            break
        right += n
    left, n = at, 32
    while left > begin:
        n = min(2 * n, left - begin)
        same = (words[left - n:left] == words[left - n + period:left + period])[::-1]
        if not same.all():
            left -= int(same.argmin())
            break
        left -= n
    return left, right + period


def runs_of(words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, by document, start
    and period. ``offsets``: where each document's words begin and end."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    position, period = candidates(words, doc, begin, end)
    by = np.lexsort((position, period, doc[position]))
    position, period = position[by], period[by]
    where = doc[position]
    border = np.flatnonzero((where[1:] != where[:-1]) | (period[1:] != period[:-1])) + 1
    out = []
    for k, stop in zip([0, *border.tolist()], [*border.tolist(), len(position)], strict=True):
        while k < stop:
            q, d = int(period[k]), int(where[k])
            left, right = _agreeing(words, int(position[k]), q, int(offsets[d]), int(offsets[d + 1]))
            if right - left >= max(MIN_WORDS, MIN_EXPONENT * q):
                out.append((d, left - int(offsets[d]), right - left, q))
            # Blocks that lie in this stretch are the same candidate.
            k += int(np.searchsorted(position[k:stop], right - q, "right"))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each word, offsets of each text's words)."""
    import pyarrow.compute as pc

    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = parts.flatten()
    solid = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    offsets = parts.offsets.to_numpy()
    before = np.concatenate(([0], np.cumsum(solid)))
    return codes[solid], before[offsets - offsets[0]]


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` text bytes, each of a row or more."""
    import pyarrow.compute as pc

    total = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < batch.num_rows:
        past = total[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(total, past + size, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def find_runs(docs: DataFrame) -> DataFrame:
    """Runs of every document (doc_id, text) as arrays ordered by start and
    period, and the text without the repeats: of each run only the first
    ``period`` words stay, words joined by one space."""
    small_batches(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            for part in _parts(batch, BATCH_BYTES):
                texts = pa.array(part.column(1).to_pylist(), pa.large_string()).fill_null("")
                words, offsets = numbered(texts)
                split = [t.split() for t in pc.cast(texts, pa.large_binary()).to_pylist()]
                starts, lengths, periods = ([[] for _ in split] for _ in range(3))
                stay: dict[int, np.ndarray] = {}
                for d, start, length, period in runs_of(words, offsets):
                    starts[d].append(start)
                    lengths[d].append(length)
                    periods[d].append(period)
                    stay.setdefault(d, np.ones(len(split[d]), bool))[start + period:start + length] = False
                for d, kept in stay.items():
                    split[d] = [split[d][k] for k in np.flatnonzero(kept).tolist()]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(starts, longs),
                     pa.array(lengths, longs), pa.array(periods, longs),
                     pa.array([b" ".join(w) for w in split], pa.binary()).cast(pa.string())],
                    [f.split()[0] for f in RUNS_SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, RUNS_SCHEMA)


def runs_report(docs: DataFrame) -> DataFrame:
    """Per document: its number of runs, the run of the greatest exact
    exponent, and SHA-256 digests of all runs and of the collapsed text."""
    run = F.arrays_zip(F.col("starts").alias("s"), F.col("lengths").alias("n"), F.col("periods").alias("q"))
    # Greatest n / q; ties: smallest start, then period. Products compare
    # exactly (lengths below 2^31).
    better = lambda a, b: (
        F.when(a.isNull(), b).when(b["n"] * a["q"] > a["n"] * b["q"], b).otherwise(a))
    found = find_runs(docs).withColumn("runs", run)
    nothing = F.lit(None).cast("struct<s:bigint,n:bigint,q:bigint>")
    best = found.withColumn("best", F.aggregate("runs", nothing, better))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["s"], r["n"], r["q"]))
    told = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        F.col("best.n").alias("length"), F.col("best.q").alias("period"),
        F.expr("(1000 * best.n) div best.q").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

