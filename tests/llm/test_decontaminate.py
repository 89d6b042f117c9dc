import hashlib
import random
import re

import pytest

from ledgerline.llm import decontaminate
from tests.llm.conftest import DOCS, doc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    doc_words = words(text)
    hit, found = [False] * len(doc_words), set()
    for item_id, item in items:
        item_words = words(item)
        if not item_words:
            continue
        n = min(10, len(item_words))
        windows = {tuple(item_words[k:k + n]) for k in range(len(item_words) - n + 1)}
        for k in range(len(doc_words) - n + 1):
            if tuple(doc_words[k:k + n]) in windows:
                hit[k:k + n] = [True] * n
                found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(doc_words), sum(hit), len(found), digest, any(hit)


@pytest.fixture(scope="module")
def case(spark, rows):
    rng = random.Random(3)
    item = lambda n, v=60: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    items = [(k, item(rng.randint(10, 40))) for k in range(40)]
    items += [(100, "w3 w4"), (101, "w4"), (102, ""), (103, None), (104, "¡w5—w6! w5"),
              (105, items[0][1]), (106, items[1][1][:40]), (107, "w1 " * 14), (2, "w9 w8 w7")]
    docs = list(rows)
    for k in range(60):
        part = words(rng.choice(items[:40])[1])
        cut = part[rng.randrange(3):][:rng.choice([5, 9, 10, 11, 30])]
        docs.append(doc(500 + k, f"{item(20)}; {', '.join(cut).upper()}. {item(rng.randint(0, 30))}"))
    docs.append(doc(900, " ".join(t for _, t in items[:3])))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), docs, items


def report(docs, benchmark):
    return sorted(str(tuple(r)) for r in decontaminate.contamination_report(docs, benchmark).collect())


def test_report_equals_brute_force(case):
    docs, benchmark, rows, items = case
    assert report(docs, benchmark) == sorted(str((r[0], *brute(r[1], items))) for r in rows)


def test_blocks_of_items_give_the_same(case, monkeypatch):
    docs, benchmark, rows, items = case
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    assert len([*decontaminate._blocks(benchmark)]) > 2
    assert report(docs, benchmark) == sorted(str((r[0], *brute(r[1], items))) for r in rows)


def test_spans_go_and_clean_documents_stay(case):
    docs, benchmark, rows, items = case
    long_items = benchmark.where("item_id < 40")
    out = decontaminate.decontaminate(docs, long_items)
    assert out.columns == docs.columns
    kept = {}
    for r in out.collect():
        kept.setdefault((r.doc_id, r.text), r)
    left = {i for i, _ in kept}
    for r in rows:
        n, hit, *_, dirty = brute(r[1], items[:40])
        if not dirty:
            assert (r[0], r[1]) in kept and kept[r[0], r[1]].n_chars == r[4]
        else:
            assert (r[0], r[1]) not in kept
            assert (r[0] in left) == (2 * hit <= n)
    assert 900 not in left
    again = decontaminate.contamination_report(out, long_items)
    assert all(r.n_chars == len(t) for (_, t), r in kept.items() if t is not None)
    assert again.where("contaminated").count() < docs.count() / 20


def test_short_items_leave_clean_documents_alone(spark):
    passage = " ".join(f"q{k}" for k in range(12))
    items = spark.createDataFrame([(1, "yes"), (2, "New York"), (3, passage)], "item_id long, text string")
    rows = [doc(1, "Yes."), doc(2, "yes, New York"), doc(3, "I said yes in New York and went home."),
            doc(4, f"yes to all of this: {passage} and then to much more that is said in New York, yes, a lot"),
            doc(5, f"yes {passage}")]
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), items).collect()}
    assert {k: got[k] for k in (1, 2, 3)} == {r[0]: r[1] for r in rows[:3]}
    assert got[4] == rows[3][1].replace(passage, "") and 5 not in got
    report = decontaminate.contamination_report(spark.createDataFrame(rows, DOCS), items)
    assert report.where("contaminated").count() == 5


def test_whole_items_of_five_to_nine_words_go(spark):
    items = spark.createDataFrame([(1, "who wrote the third book of songs"), (2, "a"), (3, "yes"), (4, "to be or not")],
                                  "item_id long, text string")
    rest = "and here is much more to read that no item has in it"
    rows = [doc(1, f"Ask: Who wrote the third book of songs? {rest}"), doc(2, f"yes a yes a yes a yes a {rest}"),
            doc(3, "who wrote the third book of songs"), doc(4, f"to be or not {rest}"),
            doc(5, f"who wrote the third book of {rest}")]
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), items).collect()}
    assert got == {1: f"Ask: ? {rest}", **{r[0]: r[1] for r in rows if r[0] in (2, 4, 5)}}


def test_one_python_stage_for_many_blocks_and_repeated_items(case, monkeypatch):
    docs, benchmark, rows, items = case
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    many = benchmark.unionByName(benchmark).unionByName(benchmark)
    assert len(decontaminate._blocks(many)) > 25
    found = decontaminate.contamination_report(docs, many)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(str((r[0], *brute(r[1], items))) for r in rows)
    cut = sorted(map(str, decontaminate.decontaminate(docs, many).collect()))
    monkeypatch.undo()
    assert sorted(map(str, decontaminate.decontaminate(docs, benchmark).collect())) == cut


def test_empty_tables(spark, docs, empty, case):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(docs, none).where("contaminated").count() == 0
    assert decontaminate.contamination_report(empty, case[1]).count() == 0
    assert decontaminate.decontaminate(empty, case[1]).count() == 0
