"""Conversation structure repair (operator 11).

A conversation's role initials must read ``(s?(ua)+)?``. Rows are kept,
reroled, deleted, or empty ones inserted, at the least total cost; among the
cheapest edits those whose initials (D, I, K, R) are ASCII-least.

Four-Russians block tables. The automaton has four states (START, SYSTEM,
USER, ASSISTANT); the cost to reach a legal end from each of them is a vector
of four numbers. Less its minimum, such a vector has entries up to 12 only,
so there are few, and they are numbered. ``BlockTable`` holds, for every
vector and every block of ``BLOCK`` row symbols, the vector before the block
and what its minimum grew by. Rows go through it from the last block to the
first, one lookup a block. Then each block is expanded backward from the
vector kept at its right end, which gives the cost to go at every row; a walk
from the start takes at each place the least letter that stays on a cheapest
path. From one place each letter leads to one place only, so comparing
letters one at a time is comparing the whole strings: ties are safe.

On Spark, equal rows are counted before the shuffle (all but the first of
them can only be deleted), rows are range-partitioned in reading order, and
each task repairs the conversations that lie whole in its partition. Those
that cross partitions or are longer than ``PIECE_ROWS`` become pieces: a
piece's effect is one map from vector to vector, and two scans over these
small maps (costs from the right, states from the left) let all pieces be
traced side by side. A scan holds one vector or state at a time, whatever
the conversation's length.

Defined cases: rows read by turn (nulls first), then role and text in byte
order; a null role or text is one space; a null ``conv_id`` is a
conversation of its own; an empty role has no initial and is no legal role;
a conversation left without rows keeps its report row; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import SPACES, small_batches, stored

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled row, by the state before it.
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits; a truncated row that stays adds one.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Row symbols: padding, must be deleted, then initial (s, u, a, other) times
#: (whole, truncated).
PAD, GONE, FIRST_ROLE = 0, 1, 2
INITIALS = "sua"
SYMBOLS = FIRST_ROLE + 8
BLOCK = 4
#: Rows and text bytes of one piece of a long or divided conversation.
PIECE_ROWS = 4096
PIECE_BYTES = 4 << 20

LEGAL = {"su", "ua", "au"}


def _kept(state: int, initial: int) -> int | None:
    """The state after a row of this initial stays as it is."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what can become of a row."""
    if symbol == PAD:
        return [("", 0, state)]
    out = [("D", DELETE, state)]
    if symbol != GONE:
        initial, cut = divmod(symbol - FIRST_ROLE, 2)
        after = _kept(state, initial)
        if after is not None:
            out.append(("K", TRUNCATED * cut, after))
        out.append(("R", REROLE + TRUNCATED * cut, NEXT[state]))
    return out


def _with_inserts(cost: list[int]) -> tuple[int, ...]:
    for _ in range(2):
        cost = [min(c, INSERT + cost[NEXT[p]]) for p, c in enumerate(cost)]
    return tuple(cost)


def before(cost: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Cost to go in front of a row, from that behind it."""
    return _with_inserts([min(c + cost[q] for _, c, q in edits(p, symbol)) for p in range(4)])


AT_END = _with_inserts([0 if p in ENDS else 10 ** 6 for p in range(4)])


class BlockTable:
    """Vectors, and the transition of every vector over every block."""

    def __init__(self, length: int = BLOCK):
        self.length = length
        self.vectors: list[tuple[int, ...]] = []
        ids: dict[tuple[int, ...], int] = {}

        def number(cost) -> tuple[int, int]:
            low = min(cost)
            vector = tuple(c - low for c in cost)
            if vector not in ids:
                ids[vector] = len(self.vectors)
                self.vectors.append(vector)
            return ids[vector], low

        self.end, _ = number(AT_END)
        step, grow, k = [], [], 0
        while k < len(self.vectors):
            found = [number(before(self.vectors[k], s)) for s in range(SYMBOLS)]
            step.append([f[0] for f in found])
            grow.append([f[1] for f in found])
            k += 1
        step, grow = np.array(step, np.int32), np.array(grow, np.int64)
        # A block is read from its last row to its first: a row in front
        # multiplies the code of the rows behind it.
        self.to, self.add = step, grow
        for _ in range(length - 1):
            self.add = (grow[self.to] + self.add[:, :, None]).transpose(0, 2, 1).reshape(len(step), -1)
            self.to = step[self.to].transpose(0, 2, 1).reshape(len(step), -1)
        self.weights = SYMBOLS ** np.arange(length - 1, -1, -1)

    def blocks(self, symbols: bytes) -> list[int]:
        """Codes of a row sequence's blocks, the last one padded."""
        padded = np.frombuffer(symbols + bytes(-len(symbols) % self.length), np.uint8)
        return (padded.reshape(-1, self.length).astype(np.int64) @ self.weights).tolist()

    def over(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A whole piece as a map: vector and growth for every vector."""
        to = np.arange(len(self.vectors))
        add = np.zeros(len(self.vectors), np.int64)
        for code in reversed(self.blocks(symbols)):
            add += self.add[to, code]
            to = self.to[to, code]
        return to, add

    def trace(self, symbols: bytes, right: int) -> list[tuple[str, int]]:
        """For each state in front of a piece: the edits, and the state
        behind. ``right`` is the vector behind the piece."""
        at, kept = right, []
        for code in reversed(self.blocks(symbols)):
            kept.append((at, code))
            at = int(self.to[at, code])
        parts = [expand(self.vectors[behind], code, self.length) for behind, code in reversed(kept)]
        ways = []
        for state in range(4):
            text = []
            for part in parts:
                letters, state = part[state]
                text.append(letters)
            ways.append(("".join(text), state))
        return ways


@lru_cache(maxsize=1)
def block_table() -> BlockTable:
    return BlockTable()


@lru_cache(maxsize=1 << 16)
def expand(behind: tuple[int, ...], code: int, length: int) -> list[tuple[str, int]]:
    """One block, expanded backward: for each state in front of it, the
    least letters on a cheapest path through it and the state behind."""
    symbols = [code // SYMBOLS ** k % SYMBOLS for k in range(length - 1, -1, -1)]
    costs = [behind]
    for symbol in reversed(symbols):
        costs.append(behind if symbol == PAD else before(costs[-1], symbol))
    costs.reverse()
    out = []
    for state in range(4):
        letters = []
        for k, symbol in enumerate(symbols):
            letter = "" if symbol == PAD else "I"
            while letter == "I":
                ways = [(e, q) for e, c, q in edits(state, symbol) if c + costs[k + 1][q] == costs[k][state]]
                if INSERT + costs[k][NEXT[state]] == costs[k][state]:
                    ways.append(("I", NEXT[state]))
                letter, state = min(ways)
                letters.append(letter)
        out.append(("".join(letters), state))
    return out


def at_end(state: int) -> str:
    """Inserts behind the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def apply(audit: str, state: int, symbols: bytes, roles: list[str],
          texts: list[str]) -> tuple[list[str], list[str], int]:
    """Roles and texts that the edits leave, and what the edits cost.
    ``roles`` and ``texts`` hold the rows that may stay."""
    new_roles, new_texts, row, k, cost = [], [], 0, 0, 0
    for letter in audit:
        if letter == "I":
            state, cost = NEXT[state], cost + INSERT
            new_roles.append(ROLE[state])
            new_texts.append("")
            continue
        symbol, row = symbols[row], row + 1
        if letter == "D":
            cost += DELETE
        else:
            initial, cut = divmod(symbol - FIRST_ROLE, 2)
            state = _kept(state, initial) if letter == "K" else NEXT[state]
            cost += TRUNCATED * cut + REROLE * (letter == "R")
            new_roles.append(roles[k] if letter == "K" else ROLE[state])
            new_texts.append(texts[k])
        k += symbol != GONE
    return new_roles, new_texts, cost


@dataclass
class Piece:
    """Rows of one conversation in order, with what two pieces need to be
    counted as one."""

    symbols: bytearray
    roles: list
    texts: list
    size: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str | None = None
    last_initial: str | None = None

    @classmethod
    def new(cls) -> Piece:
        return cls(bytearray(), [], [])

    def row(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        elif self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            if turn != self.last_turn:
                self.turns += 1
                self.last_turn = turn
        if fault == BLANK:
            self.blank += 1
        elif fault == DUPLICATE:
            self.duplicate += 1
        if fault in (BLANK, DUPLICATE):
            self.symbols.append(GONE)
            return
        cut = fault == CUT
        self.truncated += cut
        place = INITIALS.find(initial) if initial else -1
        self.symbols.append(FIRST_ROLE + 2 * (place if place >= 0 else 3) + cut)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text) + len(role)

    def copies(self, n: int, fault: int) -> None:
        """``n`` more rows equal to the last one."""
        self.symbols += bytes([GONE]) * n
        self.illegal += n
        if fault == BLANK:
            self.blank += n
        else:
            self.duplicate += n


#: A row's first fault.
WHOLE, BLANK, DUPLICATE, CUT = range(4)

PIECE_FIELDS = (
    "whole boolean, part int, seq long, symbols binary, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, "
    "last_turn long, first_initial string, last_initial string, audit string, cost long")
REPORT_FIELDS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                 "audit string, repaired_sha256 string")


def _ordered(rows: DataFrame, copies: str | None) -> DataFrame:
    """Distinct rows in reading order with their number of copies (0: a
    conversation's place holder) and first fault, range-partitioned."""
    n = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("conv_id", *[F.when(n > 0, c).alias(a) for a, c in (
        ("turn", F.col("turn").cast("long")), ("role", role), ("text", text))], n.alias("copies"))
    order = ("conv_id", "turn", "role", "text")
    rows = stored(rows.groupBy(*order).agg(F.sum("copies").alias("copies")), "conversation-rows")
    said = F.when(F.col("copies") > 0, F.sha2(
        F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    # The smallest turn of equal role and text; a null turn comes first.
    nth = F.struct(F.col("turn").isNotNull().alias("k"), F.col("turn").alias("t"))
    rows = rows.withColumn("said", said).withColumn("nth", nth)
    seen = (rows.where("said is not null").groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s"))
            .agg(F.min("nth").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(trimmed == "", BLANK)
             .when(F.col("first").isNotNull() & ~F.col("nth").eqNullSafe(F.col("first")), DUPLICATE)
             .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), CUT).otherwise(WHOLE))
    return (joined.select(*order, "copies", fault.alias("fault"))
            .repartitionByRange(*order).sortWithinPartitions(*order))


def _with_id(df: DataFrame, fields: str) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {fields}"


def _names(fields: str) -> list[str]:
    return ["conv_id", *[f.split()[0] for f in fields.split(", ")]]


def _pieces(ordered: DataFrame, piece_rows: int, piece_bytes: int) -> DataFrame:
    """Repaired whole conversations, and unrepaired pieces of the others."""
    names = _names(PIECE_FIELDS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part, out = block_table(), TaskContext.get().partitionId(), []
        piece, conv, n_convs, seq, split, types = None, None, 0, 0, False, []

        def emit(whole: bool) -> None:
            nonlocal seq
            symbols, roles, texts, audit, cost = bytes(piece.symbols), piece.roles, piece.texts, None, None
            if whole:
                audit, state = table.trace(symbols, table.end)[START]
                audit += at_end(state)
                roles, texts, cost = apply(audit, START, symbols, roles, texts)
            out.append((conv, whole, part, seq, symbols, roles, texts, piece.blank, piece.duplicate,
                        piece.truncated, piece.illegal, piece.turns, piece.first_turn, piece.last_turn,
                        piece.first_initial, piece.last_initial, audit, cost))
            seq += 1

        def ready() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        def open_piece() -> None:
            nonlocal piece, split
            if len(piece.symbols) >= piece_rows or piece.size >= piece_bytes:
                emit(False)
                piece, split = Piece.new(), True

        for b in batches:
            types = [b.schema.field(0).type, pa.bool_(), pa.int32(), pa.int64(), pa.binary(),
                     pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 7, *[pa.string()] * 3, pa.int64()]
            for c, turn, role, text, copies, fault in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                if piece is None or c != conv:
                    if piece is not None:
                        # The partition's first may have begun before.
                        emit(n_convs > 1 and not split)
                        if len(out) >= 1000:
                            yield ready()
                    piece, conv, split = Piece.new(), c, False
                    n_convs += 1
                if copies:
                    open_piece()
                    piece.row(turn, role, text, fault)
                    copies -= 1
                again = BLANK if fault == BLANK else DUPLICATE
                while copies:
                    open_piece()
                    if not piece.symbols:
                        piece.row(turn, role, text, again)
                        copies -= 1
                    n = min(copies, max(0, piece_rows - len(piece.symbols)))
                    piece.copies(n, again)
                    copies -= n
                    if len(out) >= 1000:
                        yield ready()
        if piece is not None:
            emit(False)
        if out:
            yield ready()

    return ordered.mapInArrow(cut, _with_id(ordered, PIECE_FIELDS))


def _scanned(pieces: DataFrame, columns: list[str], ascending: bool, step, fields: str) -> DataFrame:
    """A scan over the pieces of each conversation in (or against) reading
    order. ``step`` is a generator that gets (begins, row) and gives rows."""
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in ("part", "seq")]
    rows = (pieces.select("conv_id", "part", "seq", *columns).repartition("conv_id")
            .sortWithinPartitions("conv_id", *order))
    schema = T.StructType.fromDDL(fields)
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in schema.fields]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
        conv = object()
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
                yield row[0] != conv, row
                conv = row[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for found in step(told(batches)):
            out.append(found)
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(scan, fields)


def _maps(pieces: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block_table()
        for b in batches:
            to = [table.over(s)[0].tolist() for s in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(to, pa.list_(pa.int32()))], ["conv_id", "part", "seq", "over"])

    return pieces.select("conv_id", "part", "seq", "symbols").mapInArrow(
        read, _with_id(pieces, "part int, seq long, over array<int>"))


def _behind(rows):
    """Against reading order: the vector behind each piece."""
    end = at = block_table().end
    for begins, (_, part, seq, over) in rows:
        at = end if begins else at
        yield part, seq, at
        at = over[at]


def _traced(pieces: DataFrame) -> DataFrame:
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block_table()
        for b in batches:
            ways = [table.trace(s, v) for s, v in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([[a for a, _ in w] for w in ways], pa.list_(pa.string())),
                 pa.array([[q for _, q in w] for w in ways], pa.list_(pa.int32()))],
                ["conv_id", "part", "seq", "audits", "exits"])

    return pieces.select("conv_id", "part", "seq", "symbols", "behind").mapInArrow(
        trace, _with_id(pieces, "part int, seq long, audits array<string>, exits array<int>"))


def _entered(rows):
    """In reading order: the state in front of each piece and its edits; a
    conversation's last piece also gets the inserts behind it."""
    held, state = None, START
    for begins, (_, part, seq, audits, exits) in rows:
        if held:
            yield (*held[:3], held[3] + (at_end(state) if begins else ""))
        state = START if begins else state
        held = part, seq, state, audits[state]
        state = exits[state]
    if held:
        yield (*held[:3], held[3] + at_end(state))


def _applied(pieces: DataFrame) -> DataFrame:
    names = _names(PIECE_FIELDS)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = {n: b.column(n) for n in b.schema.names}
            found = [apply(*x) for x in zip(*(columns[n].to_pylist() for n in (
                "audit", "entry", "symbols", "roles", "texts")), strict=True)]
            columns |= {"roles": pa.array([f[0] for f in found], pa.list_(pa.string())),
                        "texts": pa.array([f[1] for f in found], pa.list_(pa.string())),
                        "cost": pa.array([f[2] for f in found], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return pieces.mapInArrow(repair, _with_id(pieces, PIECE_FIELDS))


def repair(conversations: DataFrame, copies: str | None = None, piece_rows: int = PIECE_ROWS,
           piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Repaired conversations as pieces in the order (part, seq): the rows
    left (``roles``, ``texts``), the edits (``audit``, ``cost``) and the
    faults counted. ``copies`` names a column that says how often a row
    counts; 0 keeps a conversation without the row."""
    spark = conversations.sparkSession
    small_batches(spark)
    pieces = stored(_pieces(_ordered(conversations, copies), piece_rows, piece_bytes), "conversation-pieces")
    whole, parts = pieces.where("whole"), pieces.where("not whole").drop("audit", "cost")
    place = ["part", "seq"]
    behind = stored(_scanned(_maps(parts), ["over"], False, _behind, "part int, seq long, behind int"),
                    "conversation-costs")
    traced = stored(_traced(parts.join(behind, place)), "conversation-traced")
    entered = stored(_scanned(traced, ["audits", "exits"], True, _entered,
                              "part int, seq long, entry int, audit string"), "conversation-entered")
    small_batches(spark, 16)  # pieces of some MB each
    applied = stored(_applied(parts.join(entered, place)), "conversation-applied")
    small_batches(spark)
    return whole.select(*pieces.columns).unionByName(applied)


def _joined(rows):
    """In reading order: one report row per conversation, its text hashed as
    it goes by."""
    def row(held) -> tuple:
        turns = held["turns"]
        gaps = held["last"] - held["first"] + 1 - turns if turns else 0
        return (held["conv"], gaps, *held["counts"], held["cost"], "".join(held["audit"]), held["sha"].hexdigest())

    held = None
    for begins, (conv, _, _, roles, texts, blank, duplicate, truncated, illegal, turns, first_turn, last_turn,
                 first_initial, last_initial, audit, cost) in rows:
        if begins:
            if held:
                yield row(held)
            held = {"conv": conv, "turns": 0, "first": None, "last": None, "counts": [0] * 4, "cost": 0,
                    "audit": [], "sha": hashlib.sha256(), "any": False, "initial": None}
        if held["initial"] is not None and first_initial is not None:
            illegal += held["initial"] + first_initial not in LEGAL
        held["initial"] = held["initial"] if last_initial is None else last_initial
        if first_turn is not None:
            held["turns"] += turns - (first_turn == held["last"])
            held["first"] = first_turn if held["first"] is None else held["first"]
            held["last"] = last_turn
        held["counts"] = [a + b for a, b in zip(held["counts"], (blank, duplicate, truncated, illegal), strict=True)]
        held["cost"] += cost
        held["audit"].append(audit)
        for role, text in zip(roles, texts, strict=True):
            held["sha"].update((("\n" if held["any"] else "") + role + ":" + text).encode())
            held["any"] = True
    if held:
        yield row(held)


def repair_report(conversations: DataFrame, copies: str | None = None, piece_rows: int = PIECE_ROWS,
                  piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, the faults, ``cost``,
    ``audit`` and the SHA-256 of the repaired text."""
    pieces = repair(conversations, copies, piece_rows, piece_bytes)
    said = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    gaps = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"))
    whole = pieces.where("whole").select(
        "conv_id", F.coalesce(gaps, F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", F.sha2(F.array_join(said, "\n"), 256).alias("repaired_sha256"))
    fields = _with_id(pieces, REPORT_FIELDS)
    parts = _scanned(pieces.where("not whole"), [
        "roles", "texts", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn",
        "first_initial", "last_initial", "audit", "cost"], True, _joined, fields)
    return whole.unionByName(parts)
