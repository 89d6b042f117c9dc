import hashlib
import random
import re
import time

from ledgerline.llm import pii
from tests.llm.conftest import DOCS, doc

BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}
KINDS = list(BASE)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d)
                    or kind == "phone" and 10 <= len(d) <= 15):
                found.append((m.start(), KINDS.index(kind), m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


CASES = [
    "mail a.b+c@x-y.co.uk, a@b@c.d.e or @x.y, me@host and Ü@é.com é.x@y.z",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 1..2.3.4 10.0.0.255: 999999999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 79927398713",
    "+1 (017) 555-7713 ++44 20 7946 0958. +1-2 +4912345678901234 +1 (2) 3.4-5 6 7 8 9 0 1)",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, GB82 WEST 1234 5698 7654 33",
    "SSN 219-09-9999 (social security), part 219-09-9999. call 415-555-2671 or order 415-555-2671",
    "9" * 3000, "a" * 50_000 + "@", "+" * 2000 + "1" * 30, "1." * 3000, "x@" * 2000, "é" * 10 + "5105105105105100",
]


def test_base_spans_equal_brute_force():
    rng = random.Random(0)
    noise = ["".join(rng.choice("0123456789.-+@ ()abÉ%\n") for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    for text in [*CASES, *noise, None, ""]:
        got = [s[:3] for s in pii.find(text) if s[0] in KINDS]
        assert got == brute(text), text


def test_added_kinds_need_checksum_or_context():
    added = lambda t: [(k, t[a:b]) for k, a, b, _ in pii.find(t) if k not in KINDS]
    assert added(CASES[4]) == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")]
    assert added("SSN 219-09-9999") == [("ssn", "219-09-9999")]
    assert added("part 219-09-9999") == [] and added("SSN 000-09-9999") == []
    assert added("call 415-555-2671") == [("tel", "415-555-2671")] and added("see 415-555-2671") == []
    (near,), (far,) = pii.find("visa card 4111111111111111"), pii.find("4111111111111111")
    assert near[3] > far[3]


def test_report_and_redaction(spark, rows):
    docs = spark.createDataFrame([*rows, *(doc(5000 + k, t) for k, t in enumerate(CASES))], DOCS)
    got = {(r.doc_id, r.spans): r for r in pii.pii_report(docs).collect()}
    by_id = {i: r for (i, _), r in got.items()}
    for k, text in enumerate(CASES):
        r, want = by_id[5000 + k], brute(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == x for s in want) for x in KINDS]
        joined = ",".join(f"{x}:{a}:{b}" for x, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.pii_report(docs).count() == docs.count()
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[5001].text == "[ip].[ip] 256.1.1.1 [ip] 1..2.3.4 [ip]: 999999999999999999999999.1.1.1"
    assert texts[5001].n_chars == len(texts[5001].text)
    assert texts[8].text == next(r[1] for r in rows if r[0] == 8)


def test_empty_table(empty):
    assert pii.pii_report(empty).count() == 0


def test_iban_before_and_after_other_groups():
    text = "IBAN BE68 5390 0754 7034 BANK"
    assert [s[:3] for s in pii.find(text)] == [("iban", 5, 24)]
    text = "account BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00"
    assert [text[a:b] for k, a, b, _ in pii.find(text) if k == "iban"] == [
        "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"]


def test_dropped_proposals_block_nothing_and_many_are_linear():
    text = "call 555-123-4567 now " * 20_000
    start = time.perf_counter()
    found = pii.find(text)
    assert time.perf_counter() - start < 10
    assert len(found) == 20_000 and {s[0] for s in found} == {"tel"}
    # Brute force: no added span overlaps another span.
    mixed = "ssn 123-45-6789 tel 555-123-4567 card 4111111111111111 IBAN BE68539007547034 a@b.co " * 5
    spans = pii.find(mixed)
    for k, a, b, _ in spans:
        if k in pii.ADDED_KINDS:
            assert sum(x < b and a < y for _, x, y, _ in spans) == 1
