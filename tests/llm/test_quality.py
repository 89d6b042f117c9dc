import re
from collections import Counter

from ledgerline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[k:k + 8]) for k in range(n - 7))
    covered = [False] * n
    for k in range(n - 7):
        if windows[tuple(words[k:k + 8])] > 1:
            covered[k:k + 8] = [True] * 8
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    dup, repeat, chars = len(lines) - len(set(lines)), sum(covered), sum(map(len, words))
    failed = n < 20 or 100 * repeat > 30 * n
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    kept = not (failed or 10 * symbols > n or 2 * dup > len(lines) or chars < 2 * n or chars > 15 * n
                or 2 * text.count("!") > n or 5 * adjacent > n)
    return n, chars, symbols, dup, repeat, failed, kept


def test_report_equals_brute_force(docs, rows):
    got = sorted(map(tuple, quality.quality_report(docs).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_every_order_keeps_the_same_documents(docs, rows):
    want = sorted(str((r[0], r[1])) for r in rows if brute(r[1])[-1])
    assert want
    for order in (list(quality.RULES), list(quality.RULES)[::-1]):
        kept = quality.keep(docs, order=order)
        assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want


def test_rules_are_ordered_by_rejection_per_cost():
    rules = [quality.Rule(n, (), "true") for n in "abc"]
    estimates = [quality.RuleEstimate("a", 1.0, 0.1), quality.RuleEstimate("b", 1.0, 0.5),
                 quality.RuleEstimate("c", 0.1, 0.2)]
    assert [r.name for r in quality.order_rules(rules, estimates)] == ["c", "b", "a"]


def test_later_features_wait_for_earlier_rules(docs):
    plan = quality.keep(docs, order=list(quality.RULES))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "Python" not in plan
    assert plan.count("split(") == 2  # words and lines, once each


def test_empty_table(empty):
    assert quality.quality_report(empty).count() == 0
    assert quality.keep(empty).count() == 0
