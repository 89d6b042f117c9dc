r"""Benchmark decontamination with a generalised suffix automaton (operator 5).

Benchmark items are normalised to words (A-Z lower-cased; runs of ASCII
letters, digits and non-ASCII characters) and all substrings of all items
are held in one suffix automaton over word ids. Each document's words are
streamed through it; at every word the automaton knows the longest suffix
that occurs in some item. A match of at least ``window`` words, or of the
whole of an item shorter than that, marks its words as hit.

``contamination_report`` counts; ``decontaminate`` acts: words in matches of
at least ``min_span`` words (by default ``MIN_SPAN``, so whole items of 5 to 9
words too) are cut from the text, and a document of which they are more than
``max_coverage`` is dropped. Shorter items, such as an answer of one word,
are counted but not acted on, however many stand in a row: clean texts are
full of them.

Equal items are held once. Blocks of about ``BLOCK_BYTES`` of item text become
one automaton each, built by a task each and kept in the shared work folder.
One stage scans the documents: a task holds up to ``CHUNK_BYTES`` of texts
and walks the automata over them, one in memory at a time. No item text is
on the driver, and documents are not shuffled.

Defined cases: null or empty texts have no words and no hits; an item
without words matches nothing; repeated items each count; a null item_id is
never listed; an empty benchmark leaves every document clean; an empty
documents table gives an empty result; columns pass through unchanged
(working columns start with ``__d_``).
"""

from __future__ import annotations

import pickle
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import open_fs, small_batches, worker_state
from ledgerline.session import scratch_path

WINDOW = 10
#: Item words below which a match is counted but not cut.
MIN_SPAN = 5
#: Mean item text that one automaton is built from.
BLOCK_BYTES = 4 << 20
#: Text that a task holds while several automata pass over it.
CHUNK_BYTES = 32 << 20

#: Byte table: A-Z to lower case, every ASCII byte outside letters and
#: digits to a space; UTF-8 bytes of other characters stay.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def word_spans(text: bytes) -> np.ndarray:
    """Byte offsets (start, end) of the words, one row each."""
    inside = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)


class Automaton:
    """Generalised suffix automaton of the items' word sequences. Most states
    have one transition: it lies in two arrays, further ones in dicts."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.first, self.to = array("i", [-1]), array("i", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.items: list[str | None] = []
        coded = []
        for item_id, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append(ids)
                self.items.append(item_id)
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        n = len(self.first)
        #: Per state of a window's words, the item that has it (-1: none) and
        #: further ones; state of a whole short item's words -> (its length, item).
        self.holder = array("i", [-1]) * n
        self.holders: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, ids in enumerate(coded):
            state = 0
            for c in ids:
                state = self.go(state, c)
                if len(ids) >= window:
                    at = self._suffix(state, window)
                    if at and self.holder[at] < 0:
                        self.holder[at] = item
                    elif at and self.holder[at] != item:
                        self.holders.setdefault(at, set()).add(item)
            if len(ids) < window:
                self.short.setdefault(self._suffix(state, len(ids)), []).append((len(ids), item))
        #: Nearest state on the link path, itself included, with short items.
        self.short_above = array("i", [0]) * n
        if self.short:
            for s in np.argsort(np.asarray(self.length), kind="stable").tolist()[1:]:
                self.short_above[s] = s if s in self.short else self.short_above[self.link[s]]
        self.shortest = min([len(ids) for ids in coded] + [window])

    def go(self, state: int, c: int) -> int:
        """The state after ``c``; -1 where there is none."""
        if self.first[state] == c:
            return self.to[state]
        more = self.more.get(state)
        return more.get(c, -1) if more else -1

    def _set(self, state: int, c: int, to: int) -> None:
        if self.first[state] in (-1, c):
            self.first[state], self.to[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _new(self, length: int) -> int:
        for column, value in ((self.first, -1), (self.to, -1), (self.link, 0), (self.length, length)):
            column.append(value)
        return len(self.first) - 1

    def _extend(self, last: int, c: int) -> int:
        q = self.go(last, c)
        if q >= 0:  # the string is there from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        cur, p = self._new(self.length[last] + 1), last
        while p != -1 and (q := self.go(p, c)) < 0:
            self._set(p, c, cur)
            p = self.link[p]
        if p != -1:
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.length[p] + 1)
        self.first[clone], self.to[clone], self.link[clone] = self.first[q], self.to[q], self.link[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        self.link[q] = clone
        while p != -1 and self.go(p, c) == q:
            self._set(p, c, clone)
            p = self.link[p]
        return clone

    def _suffix(self, state: int, n: int) -> int:
        """The state that holds the last ``n`` words of a match ending in
        ``state``; 0 if the state's own words are fewer."""
        while state and self.length[self.link[state]] >= n:
            state = self.link[state]
        return state if self.length[state] >= n else 0

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """(per word the length of the longest match it lies in or None,
        items with an occurring window). Lengths from the window on are that
        of the window."""
        n = len(words)
        ids = np.fromiter(map(self.vocabulary.get, words, [-1] * n), np.int64, n)
        # A window lies inside a run of words that all occur in some item.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        runs = edges.reshape(-1, 2)
        hit, items = None, set()
        first, to, more, link, length = self.first, self.to, self.more, self.link, self.length
        none: dict[int, int] = {}
        for a, b in runs[runs[:, 1] - runs[:, 0] >= self.shortest].tolist():
            state = size = 0
            for k, c in enumerate(ids[a:b].tolist(), a):
                while True:
                    after = to[state] if first[state] == c else more.get(state, none).get(c, 0)
                    if after or not state:
                        break
                    state = link[state]
                    size = length[state]
                state = after
                size = size + 1 if state else 0
                if size < self.shortest:
                    continue
                found = []
                if size >= self.window:
                    found.append((self.window, size))
                    at = self._suffix(state, self.window)
                    if self.holder[at] >= 0:
                        items.add(self.holder[at])
                        items |= self.holders.get(at, set())
                s = self.short_above[state]
                while s:
                    for words_in, item in self.short[s]:
                        if words_in <= size:
                            found.append((words_in, words_in))
                            items.add(item)
                    s = self.short_above[link[s]] if link[s] > 0 else 0
                for level, reach in found:
                    if hit is None:
                        hit = np.zeros(n, np.int32)
                    part = hit[k + 1 - reach:k + 1]
                    np.maximum(part, level, out=part)
        return hit, {self.items[i] for i in items}


def _blocks(benchmark: DataFrame, window: int = WINDOW) -> list[str]:
    """Build the automata of the benchmark's distinct items, by hash of item
    and text, and return their files."""
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             F.col("text").cast("binary").alias("text"))
            .where("text IS NOT NULL").distinct())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // BLOCK_BYTES))
    folder = scratch_path(benchmark.sparkSession, "automata")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(i, words_of(t)) for batch in batches for i, t in zip(
            batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        if items:
            # A name of its own for each attempt; the one that counts is returned.
            path = f"{folder}/{uuid.uuid4().hex}"
            fs, base = open_fs(folder)
            fs.create_dir(base, recursive=True)
            with open_fs(path)[0].open_output_stream(open_fs(path)[1]) as out:
                pickle.dump(vars(Automaton(items, window)), out, protocol=5)
            yield pa.RecordBatch.from_pydict({"path": [path]})

    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")
    return [r.path for r in rows.repartitionById(n, block).mapInArrow(build, "path string").collect()]


def _load(path: str) -> Automaton:
    """The automaton of a file; the worker keeps the last one."""
    state = worker_state()
    if state.get("automaton_of") != path:
        state.pop("automaton", None)
        fs, name = open_fs(path)
        automaton = Automaton.__new__(Automaton)
        with fs.open_input_stream(name) as source:
            vars(automaton).update(pickle.loads(source.readall()))
        state.update(automaton=automaton, automaton_of=path)
    return state["automaton"]


_SPANS = "array<struct<start:int,end:int>>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN) -> DataFrame:
    """``docs`` with ``__d_words`` (word count), ``__d_spans`` (maximal runs
    of hit words, as word positions), ``__d_cut`` (the same of words in
    matches of ``min_span`` words or more) and ``__d_items`` (the items with
    an occurring window, sorted)."""
    small_batches(docs.sparkSession)
    out = (docs.withColumn("__d_words", F.lit(None).cast("long"))
           .withColumn("__d_spans", F.array().cast(_SPANS))
           .withColumn("__d_cut", F.array().cast(_SPANS))
           .withColumn("__d_items", F.array().cast("array<string>")))
    return out.mapInArrow(_scanner(_blocks(benchmark, window), min(min_span, window)), out.schema)


def _runs(marked: np.ndarray | None) -> list[dict[str, int]]:
    if marked is None:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= size:
            yield held
            held, held_bytes = [], 0
    if held:
        yield held


def _scanner(paths: list[str], min_span: int):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, CHUNK_BYTES if len(paths) > 1 else 0):
            texts = [t for batch in chunk for t in batch.column(
                batch.schema.names.index("text")).cast(pa.binary()).to_pylist()]
            counts: list[int] = [0] * len(texts)
            hits: list[np.ndarray | None] = [None] * len(texts)
            found: list[set] = [set() for _ in texts]
            if not paths:
                counts = [len(words_of(t)) for t in texts]
            for path in paths:
                automaton = _load(path)
                for k, text in enumerate(texts):
                    words = words_of(text)
                    counts[k] = len(words)
                    hit, items = automaton.scan(words)
                    found[k] |= items
                    if hit is not None:
                        hits[k] = hit if hits[k] is None else np.maximum(hits[k], hit)
            new = {"__d_words": pa.array(counts, pa.int64()),
                   "__d_spans": pa.array([_runs(h if h is None else h > 0) for h in hits], spans_type),
                   "__d_cut": pa.array([_runs(h if h is None else h >= min_span) for h in hits], spans_type),
                   "__d_items": pa.array([sorted(i for i in items if i is not None) for items in found],
                                         pa.list_(pa.string()))}
            start = 0
            for batch in chunk:
                yield pa.RecordBatch.from_arrays(
                    [new[name].slice(start, batch.num_rows) if name in new else batch.column(k)
                     for k, name in enumerate(batch.schema.names)], batch.schema.names)
                start += batch.num_rows
    return run


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("__d_spans", F.lit(0).cast("long"),
                      lambda a, s: a + (s["end"] - s["start"]).cast("long"))
    return scan(docs.select("doc_id", "text"), benchmark, window).select(
        "doc_id", F.col("__d_words").alias("n_words"), hit.alias("n_hit"),
        F.size("__d_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__d_items", ","), 256).alias("items_sha256"),
        (F.size("__d_spans") > 0).alias("contaminated"))


def _cutter(max_coverage: float, has_chars: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: k for k, name in enumerate(batch.schema.names)}
            texts = batch.column(at["text"]).cast(pa.binary()).to_pylist()
            all_spans = batch.column(at["__d_cut"]).to_pylist()
            totals = batch.column(at["__d_words"]).to_pylist()
            kept, changed = [], []
            for k, cut in enumerate(all_spans):
                hit = sum(s["end"] - s["start"] for s in cut)
                if hit and hit > max_coverage * totals[k]:
                    continue
                kept.append(k)
                if cut:
                    text, edges = texts[k], word_spans(texts[k])
                    parts, last = [], 0
                    for s in cut:
                        parts.append(text[last:edges[s["start"], 0]])
                        last = int(edges[s["end"] - 1, 1])
                    texts[k] = b"".join([*parts, text[last:]])
                changed.append(bool(cut))
            rows = batch.take(pa.array(kept, pa.int64()))
            new = [texts[k] for k in kept]
            columns = {"text": pa.array(new, pa.binary()).cast(batch.schema.field("text").type)}
            if has_chars:
                old = rows.column(at["n_chars"])
                columns["n_chars"] = pa.array(
                    [len(t.decode("utf-8")) if c else o for t, c, o in
                     zip(new, changed, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(
                [columns.get(name, rows.column(k)) for name, k in at.items()
                 if not name.startswith("__d_")],
                [name for name in at if not name.startswith("__d_")])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  min_span: int = MIN_SPAN, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without the words of matches of ``min_span`` words or more,
    and without documents of which these are more than ``max_coverage``.
    n_chars, where present, follows the text."""
    return scan(docs, benchmark, window, min_span).mapInArrow(
        _cutter(max_coverage, "n_chars" in docs.columns), docs.schema)
