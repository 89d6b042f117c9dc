import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from ledgerline.llm import conversation as C
from ledgerline.llm.queries import damaged

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("copies", T.StringType()), T.StructField("audit", T.StringType()),
                       T.StructField("part", T.StringType()), T.StructField("seq", T.StringType())])
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cheapest edits by a plain table from the end; rows (turn, role, text)."""
    faults = plain_faults(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = None
    for k in range(len(rows), -1, -1):
        here = {}
        for state in step:
            ways = []
            if k == len(rows):
                if state in ("", "a"):
                    ways.append((0, ""))
            else:
                role, fault = rows[k][1], faults[k]
                ways.append((2 + best[state][0], "D" + best[state][1]))
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    if role[:1] in step[state]:
                        c, a = best[role[:1]]
                        ways.append((c + more, "K" + a))
                    for i in "ua":
                        if i in step[state]:
                            c, a = best[i]
                            ways.append((c + more + 1, "R" + a))
            here[state] = min(ways, default=(10 ** 9, ""))
        for _ in range(4):
            for state in step:
                for i in "ua":
                    if i in step[state]:
                        c, a = here[i]
                        here[state] = min(here[state], (c + 5, "I" + a))
        best = here
    cost, audit = best[""]
    out, state, k = [], "", 0
    for e in audit:
        if e == "D":
            k += 1
            continue
        if e == "K":
            out.append((rows[k][1], rows[k][2]))
            state, k = rows[k][1][:1], k + 1
            continue
        i = "a" if state == "u" else "u"
        out.append(({"a": "assistant", "u": "user"}[i], "" if e == "I" else rows[k][2]))
        state, k = i, k + (e == "R")
    assert LEGAL.fullmatch("".join(r[:1] for r, _ in out))
    return cost, audit, out


def plain_report(rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = plain_faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, out = plain_repair(rows)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def plain_damage(table):
    out = defaultdict(list)
    for conv, turn, role, text in table:
        kept = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: ordered(rows) for conv, rows in out.items()}


def exhaustive(symbols):
    """(cost, letters) of the least edits, by trying every sequence."""
    best = (10 ** 9, "")

    def go(k, cost, letters, said, inserts):
        nonlocal best
        if cost > best[0] or not re.fullmatch(r"s?(ua)*u?", said) or said.startswith("a"):
            return
        if k == len(symbols) and LEGAL.fullmatch(said):
            best = min(best, (cost, letters))
        if inserts < 3:
            for i in "ua":
                go(k, cost + 5, letters + "I", said + i, inserts + 1)
        if k < len(symbols):
            initial, fault = symbols[k]
            go(k + 1, cost + 2, letters + "D", said, 0)
            if fault != "gone":
                more = 5 * (fault == "cut")
                go(k + 1, cost + more, letters + "K", said + initial, 0)
                for i in "ua":
                    go(k + 1, cost + more + 1, letters + "R", said + i, 0)

    go(0, 0, "", "", 0)
    return best


def test_tables_agree_with_every_edit_sequence():
    kinds = [("x", "gone")] + [(i, f) for i in "suax" for f in ("", "cut")]
    code = {k: C.GONE if k[1] == "gone" else C.FIRST_ROLE + 2 * "suax".index(k[0]) + (k[1] == "cut") for k in kinds}
    rng = random.Random(3)
    cases = [c for n in range(3) for c in itertools.product(kinds, repeat=n)]
    cases += [tuple(rng.choices(kinds, k=rng.randint(3, 5))) for _ in range(150)]
    for length in (1, 3, 4):
        table = C.BlockTable(length)
        assert len(table.vectors) < 200 and max(map(max, table.vectors)) <= 12
        for case in cases:
            symbols = bytes(code[c] for c in case)
            audit, state = table.trace(symbols, table.end)[C.START]
            audit += C.at_end(state)
            rows = [c for c in case if c[1] != "gone"]
            _, _, cost = C.apply(audit, C.START, symbols, [r[0] for r in rows], ["t"] * len(rows))
            assert (cost, audit) == exhaustive(case), case


def test_piece_maps_compose():
    rng, table = random.Random(4), C.block_table()
    for _ in range(50):
        symbols = bytes(rng.randint(1, C.SYMBOLS - 1) for _ in range(rng.randint(0, 40)))
        cut = rng.randint(0, len(symbols))
        right, _ = table.over(symbols[cut:])
        left, grown = table.over(symbols[:cut])
        whole, _ = table.over(symbols)
        assert (left[right] == whole).all()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "why", " ", "", "So?", "cut of", "tab\t", "Ünd.\n", "x" * 300 + "."]
    out = []
    for conv in [*range(120), None]:
        for k in range(rng.choice([1, 2, 3, 5, 8, 13, 40])):
            turn = rng.choice([k, k, k, 2 * k, None])
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", None, "u", ""]),
                        rng.choice([*texts, None, f"{rng.random()}."])))
    # One conversation of a third of the rows, and rows repeated many times.
    out += [(500, k, "user" if k % 2 else "assistant", f"{k % 97}.") for k in range(700)]
    out += [(501, 7, "user", "again.")] * 300 + [(501, 8, "assistant", " ")] * 60 + [(502, None, None, None)] * 40
    return out


@pytest.mark.parametrize("piece_rows", [C.PIECE_ROWS, 7])
def test_report_equals_plain(spark, rows, piece_rows):
    df = spark.createDataFrame([(*r, *"xxxx") for r in rows], SCHEMA).repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.repair_report(df, piece_rows=piece_rows).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert got.keys() == by.keys()
    for conv, some in by.items():
        assert got[conv] == plain_report(ordered(some)), conv


def test_damage_and_dropped_conversations(spark, rows):
    df = spark.createDataFrame([(*r, *"xxxx") for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.repair_report(damaged(df), "copies").collect()}
    want = plain_damage(rows)
    assert got.keys() == want.keys()
    for conv, some in want.items():
        assert got[conv] == plain_report(some), conv
    empty = [c for c, some in want.items() if not some]
    for conv in empty:
        assert got[conv] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_gives_the_rows(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be nice.", *"xxxx"), (1, 1, "assistant", "Hi.", *"xxxx"),
                                (1, 2, "user", "Hello", *"xxxx")], SCHEMA)
    got = C.repair(df).orderBy("part", "seq").collect()
    said = [(r, t) for p in got for r, t in zip(p["roles"], p["texts"], strict=True)]
    assert said == [("user", "Be nice."), ("assistant", "Hi.")] and "".join(p["audit"] for p in got) == "RKD"
    df = spark.createDataFrame([(1, 0, "user", "Hi.", *"xxxx"), (1, 1, "user", "Hello.", *"xxxx")], SCHEMA)
    got = C.repair(df).collect()
    assert [(p["roles"], p["texts"], p["audit"]) for p in got] == [(["user", "assistant"], ["Hi.", "Hello."], "KR")]


def test_empty_table(spark):
    assert C.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
