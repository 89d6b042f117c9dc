"""Best-fit packing into sequences (operator 13).

Documents become token ids and an end id, and go whole into sequences of
``length`` tokens; only a longer one is cut into pieces of ``length`` tokens,
the first of which may be shorter.

Length-histogram planning: what best fit does depends on how many pieces
there are of each length, not on which. One row per length (at most
``length`` rows, whatever the corpus) comes to the driver, and ``plan`` packs
counts, longest first: all equal pieces go into all equally full sequences
in one step, so a step is one line of the plan. The pieces then take the
planned slots by rank within their length: each writer task numbers its own
pieces per length, a table of (task, length) counts gives every task the
rank it starts at, and the rank is looked up in the plan. A length that a
third of all pieces have needs no sort and no common task.

Ids come from a byte-level BPE tokenizer. Its pre-tokenizer never joins a
white space character to what stands before it, so a text's ids are those of
its chunks, white space and the word after it, in turn; each distinct chunk
is encoded once and kept. A tokenizer file of another kind, and texts with
one of its special tokens, are encoded whole.

Defined cases: a null or empty text is the end id alone; rows that repeat a
doc_id are packed each on their own; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Kept, small_batches, stored, worker_state

#: Distinct chunks of either generation that a Python worker keeps.
CACHE_CHUNKS = 500_000
#: Text bytes that are encoded at once in a task.
ENCODE_BYTES = 6 << 20

PIECE_FIELDS = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long, ids binary"
PLACED_FIELDS = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
                 "offset long, ids binary")


@dataclass(frozen=True)
class PackFormat:
    tokenizer: str
    end_id: int = 2
    length: int = 1024


# White space of the pre-tokenizer's pattern, and some controls that other
# patterns count as such.
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Stands for a line break that begins a chunk.
_BREAK = "\x01"
#: Where cutting in front of every space and line break is not safe: one of
#: them between white spaces or behind one at the end, and white space other
#: than ASCII.
_CAREFUL = (r"[\t-\r ][ \n][\t-\r ]|[\t-\r ][ \n]\z|"
            r"[\x01\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_PY_SPACE = re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", _SPACE)
#: Marks that end many words; a mark is a pre-token of its own.
_MARKS = (".", ",", "!", "?", ":", ";")
_CHUNK = re.compile(f"[{_PY_SPACE}]*[^{_PY_SPACE}]+|[{_PY_SPACE}]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes every byte as a printable letter: printable
    Latin-1 bytes as themselves, the rest as the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def parts_at_spaces(tokenizer: str) -> bool:
    """Whether the tokenizer file is of the kind that chunks are safe for."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and spec["model"].get("type") == "BPE"
            and not spec["model"].get("dropout") and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
            and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", [])))


class ByteEncoder:
    """Ids of texts, without end ids."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype, self.code = (np.dtype("<u4"), "I") if wide else (np.dtype("<u2"), "H")
        self.chunked = parts_at_spaces(tokenizer)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.break_ids = self._whole(["\n"])[0]
        self.mark_ids = {m: self._whole([m])[0] for m in _MARKS}
        self.spaced = Kept()  # a space and the key, or a line break for _BREAK
        self.bare = Kept()  # the key as it stands

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, known: dict[str, bytes], chunks: list[str], front: str) -> None:
        """Ids of new chunks behind ``front``, a space or nothing. Letters
        alone are one pre-token and go straight to the model, and so do
        marks behind them, which are another."""
        rest, tokenize, code = [], self.model.tokenize, self.code
        for chunk in chunks:
            core, after, broken = chunk, b"", chunk[:1] == _BREAK
            if chunk[-1:] in _MARKS:
                core, after = chunk[:-1], self.mark_ids[chunk[-1]]
            if broken:
                core = core[1:]
            if not core.isalpha() or not core.isascii() and max(core) >= "\u0530":
                rest.append(chunk)
                continue
            ids = known.get(core) if after and not broken else None
            if ids is None:
                letters = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
                ids = array(code, [t.id for t in tokenize(letters if broken else front + letters)]).tobytes()
                if after and not broken:
                    known[core] = ids
            known[chunk] = (self.break_ids if broken else b"") + ids + after
        if rest:
            space = " " if front else ""
            texts = ["\n" + c[1:] if c[:1] == _BREAK else space + c for c in rest]
            for k in range(0, len(rest), 4096):
                known.update(zip(rest[k:k + 4096], self._whole(texts[k:k + 4096]), strict=True))

    def _spaced(self, chunks: list[str]) -> list[bytes]:
        self.spaced.age(CACHE_CHUNKS)
        return self.spaced.look_up(chunks, lambda new: self._learn(self.spaced.young, new, self.space))

    def _bare(self, chunks: list[str]) -> list[bytes]:
        self.bare.age(CACHE_CHUNKS)
        return self.bare.look_up(chunks, lambda new: self._learn(self.bare.young, new, ""))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, offsets of each text's ids)."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.chunked:
            careful = pc.match_substring_regex(texts, _CAREFUL)
            for mark in self.special:
                careful = pc.or_(careful, pc.match_substring(texts, mark))
            careful = np.flatnonzero(careful.to_numpy(zero_copy_only=False))
        else:
            careful = np.arange(len(texts))
        if not len(careful):
            return self._cut(texts)
        easy = np.setdiff1d(np.arange(len(texts)), careful)
        packed: list[bytes] = [b""] * len(texts)
        ids, ends = self._cut(texts.take(pa.array(easy)))
        for k, a, b in zip(easy.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            packed[k] = ids[a:b].tobytes()
        for k in careful.tolist():
            packed[k] = self._carefully(texts[k].as_py())
        sizes = np.array([len(p) for p in packed], np.int64) // self.dtype.itemsize
        return np.frombuffer(b"".join(packed), self.dtype), np.concatenate(([0], np.cumsum(sizes)))

    def _carefully(self, text: str) -> bytes:
        if not self.chunked or _BREAK in text or any(mark in text for mark in self.special):
            return self._whole([text])[0]
        return b"".join(self._bare(_CHUNK.findall(text)))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts that may be cut in front of every space and line break."""
        import pyarrow.compute as pc

        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " " + _BREAK), " ")
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        packed = self._spaced(distinct)
        offsets = parts.offsets.to_numpy()
        offsets = offsets - offsets[0]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        # A text's first chunk has no space in front.
        first = offsets[:-1]
        heads = [distinct[k] for k in codes[first].tolist()]
        filled = [k for k, h in enumerate(heads) if h]
        codes = codes.copy()
        codes[first] = len(packed)
        codes[first[filled]] = len(packed) + 1 + np.arange(len(filled))
        packed = [*packed, b"", *self._bare([heads[k] for k in filled])]
        sizes = np.fromiter(map(len, packed), np.int32, len(packed)) // self.dtype.itemsize
        table = np.frombuffer(b"".join(packed), self.dtype)
        n = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        small = np.int32 if max(ends[-1], len(table)) < 1 << 30 else np.int64
        place = np.repeat(((np.cumsum(sizes, dtype=np.int64) - sizes)[codes] - ends[:-1]).astype(small), n)
        place += np.arange(ends[-1], dtype=small)
        return table[place], ends[offsets]


def _encoder(tokenizer: str) -> ByteEncoder:
    state = worker_state()
    if state.get("byte_encoder_of") != tokenizer:
        state.update(byte_encoder_of=tokenizer, byte_encoder=ByteEncoder(tokenizer))
    return state["byte_encoder"]


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Non-empty batches, small ones joined up to ``size`` bytes."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def encode_pieces(docs: DataFrame, fmt: PackFormat, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, each with its number (``nth``) among those
    of its task and length."""
    small_batches(docs.sparkSession)
    end, length = fmt.end_id, fmt.length
    names = [f.split()[0] for f in PIECE_FIELDS.split(", ")]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(fmt.tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in _gathered(batches, ENCODE_BYTES):
            ids, ends = encoder.encode(batch.column(1))
            stops = ends[1:] + np.arange(1, len(ends))
            tokens = np.empty(len(ids) + len(stops), "<u4")
            body = np.ones(len(tokens), bool)
            body[stops - 1] = False
            tokens[body], tokens[stops - 1] = ids, end
            sizes = np.diff(np.concatenate(([0], stops)))
            counts = -(-sizes // length)
            doc = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            # The first piece takes what the full ones behind it leave.
            stop = sizes[doc] - (counts[doc] - 1 - piece) * length
            start = np.maximum(stop - length, 0)
            n = stop - start
            order = np.argsort(n, kind="stable")
            begins = np.flatnonzero(np.diff(n[order], prepend=-1))
            runs = np.diff(np.append(begins, len(n)))
            nth = np.empty(len(n), np.int64)
            nth[order] = np.arange(len(n)) - np.repeat(begins, runs) + seen[n[order]]
            seen[n[order][begins]] += runs
            base = (stops - sizes)[doc]
            data = memoryview(tokens.tobytes())
            cut = [data[4 * a:4 * b] for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(n.astype(np.int32)), pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                 pa.array(np.full(len(n), task, np.int32)), pa.array(nth),
                 pa.array([c.tobytes() for c in cut] if with_ids else [None] * len(n), pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECE_FIELDS)


@dataclass
class Plan:
    """Lines of the plan, ordered by (piece length, first rank). A line's
    pieces go round its ``wide`` sequences from ``sequence`` on, each round
    one piece length further than ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    wide: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def slots(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of these lengths and ranks."""
        span = int(max(rank.max(initial=0), self.rank.max(initial=0))) + 1
        line = np.searchsorted(self.length * span + self.rank, length * span + rank, "right") - 1
        turn, seat = np.divmod(rank - self.rank[line], self.wide[line])
        return self.sequence[line] + seat, self.offset[line] + turn * length


def plan(counts: dict[int, int], size: int) -> Plan:
    """Best fit, longest first, over the number of pieces of each length.

    Equally full sequences are ranges of numbers, kept by the room they have
    left. For a length, the ranges are taken from the least room that it
    fits; each sequence is filled as often as it holds the length before the
    next one is touched, as best fit does piece by piece.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    lines: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def free(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        count, rank = counts[length], 0
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, n = size, sequences, -(-count // (size // length))
                sequences += n
            each = left // length
            full = min(n, count // each)
            for wide, turns in ((full, each), (min(1, n - full), count - full * each)):
                if wide and turns and count:
                    turns = min(turns, each)
                    lines.append((length, rank, wide, first, size - left))
                    rank, count = rank + wide * turns, count - wide * turns
                    free(left - turns * length, first, wide)
                    first, n = first + wide, n - wide
            free(left, first, n)
    columns = np.array(sorted(lines), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def pack(docs: DataFrame, fmt: PackFormat, with_ids: bool = False) -> DataFrame:
    """Pieces with the sequence and offset they go to; ``ids`` (little-endian
    unsigned 32-bit) only on request."""
    pieces = stored(encode_pieces(docs, fmt, with_ids), "packing-pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "packing-counts")
    planned = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()},
                   fmt.length)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    names = [f.split()[0] for f in PLACED_FIELDS.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            sequence, offset = planned.slots(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(length), b.column(4), pa.array(sequence), pa.array(offset), b.column(6)],
                names)

    ranked = pieces.join(starts, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"), "ids")
    return ranked.mapInArrow(place, PLACED_FIELDS)


def packed_sequences(docs: DataFrame, fmt: PackFormat) -> DataFrame:
    """The sequences themselves: sequence_id, ids, and the documents in them
    in order. A group holds at most ``fmt.length`` tokens."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return pack(docs, fmt, with_ids=True).groupBy("sequence_id").agg(rows.alias("rows")).select(
        "sequence_id", F.aggregate("rows", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids"),
        F.transform("rows", lambda r: F.struct(r["doc_id"], r["piece"], r["offset"])).alias("pieces"))
