r"""Personal data (operator 9): patterns propose spans, checksums and ranges
confirm them, nearby words adjust the score.

Base kinds (``email ip card phone``) are found leftmost and non-overlapping
per kind; a proposal that fails its check is dropped and the search goes on
after it. The method adds ``iban`` (mod 97), ``ssn`` and ``tel`` (national
phone numbers), the last two only where nearby words speak for them. An IBAN ends
at the last of its groups that makes mod 97 hold, so capitals after it do not
hide it. Added spans are scored first; those that overlap a span kept before
are dropped; base spans always stay.

Each pattern is linear in the text: runs are matched possessively, the local
part of an e-mail address is found backwards from its "@", an IBAN is of
bounded length, and overlaps are found by bisection.

Defined cases: null and empty texts have no spans; repeated rows are
searched each; an empty table gives an empty result; columns pass through
unchanged (the result column is ``pii``).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "tel")
KINDS = BASE_KINDS + ADDED_KINDS

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

#: Score of a confirmed span without context, words that raise it and words
#: that lower it, by kind. Spans below KEEP are dropped, base spans never.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3, "tel": 0.35}
FOR = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "tel": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
AGAINST = {"ip": ("version", "release", "section"), "card": ("isbn", "order", "serial", "tracking"),
           "ssn": ("part", "serial", "order"), "tel": ("isbn", "order", "serial", "part")}
NEAR = 40
KEEP = 0.5
WORDS = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return found


def ibans(text: str, begin: int) -> list[tuple[int, int]]:
    """Leftmost non-overlapping; a failed one may hide another in its groups."""
    found, m = [], IBAN.search(text, begin)
    while m:
        end = m.end()
        while end > m.start() and not _confirmed("iban", text[m.start():end]):
            end = text.rfind(" ", m.start(), end)
        if end > m.start():
            found.append((m.start(), end))
        m = IBAN.search(text, max(end, m.start() + 1))
    return found


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _confirmed(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(_digits(s)) <= 15
    if kind == "iban":
        joined = s.replace(" ", "")
        return 15 <= len(joined) <= 34 and mod_97(joined)
    if kind == "ssn":
        area, group, serial = s.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return True


def score(kind: str, text: str, start: int, end: int) -> float:
    near = set(WORDS.findall(text[max(0, start - NEAR):start].lower()))
    near |= set(WORDS.findall(text[end:end + NEAR].lower()))
    value = PRIOR[kind] + 0.3 * any(w in near for w in FOR[kind])
    return round(min(1.0, value - 0.3 * any(w in near for w in AGAINST.get(kind, ()))), 2)


PATTERNS = (("ip", IP, "."), ("card", CARD, ""), ("phone", PHONE, "+"),
            ("iban", IBAN, ""), ("ssn", SSN, "-"), ("tel", TEL, ""))


def _matches(kind: str, pattern: re.Pattern, text: str, begin: int) -> list[tuple[int, int]]:
    if kind == "iban":
        return ibans(text, begin)
    return [m.span() for m in pattern.finditer(text, begin) if _confirmed(kind, m.group())]


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind in KINDS' order."""
    if not text:
        return []
    found = [("email", a, b, score("email", text, a, b)) for a, b in emails(text)]
    if first := DIGIT.search(text):
        # An IBAN's and a phone number's first digit is not its first character.
        begin = max(0, first.start() - 2)
        for kind, pattern, needs in PATTERNS:
            if needs and needs not in text:
                continue
            new = [(kind, a, b, score(kind, text, a, b)) for a, b in _matches(kind, pattern, text, begin)]
            if kind in ADDED_KINDS and new:
                starts, ends = _merged([s[1:3] for s in found])
                # The first stretch that ends after the span's start must begin at its end or later.
                new = [s for s in new if s[3] >= KEEP and (
                    (k := bisect_right(ends, s[1])) == len(ends) or starts[k] >= s[2])]
            found += new
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                             ("end", pa.int32()), ("score", pa.float64())]))


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: the spans (code points, end exclusive)."""
    small_batches(docs.sparkSession)
    out = docs.withColumn("pii", F.array().cast(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t)]
                     for t in batch.column(names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, _ARROW) if n == "pii" else batch.column(k)
                 for k, n in enumerate(names)], names)

    return out.mapInArrow(run, out.schema)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span's text replaced by its kind in brackets
    (overlapping spans: by the first's); n_chars, where present, follows."""
    marked = with_spans(docs)
    pieces = F.aggregate(
        "pii", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]),
                     F.lit("["), s["kind"], F.lit("]")).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    marked = marked.withColumn("text", F.when(F.size("pii") > 0, pieces).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        marked = marked.withColumn("n_chars", F.when(
            F.size("pii") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, a count per base kind, base_sha256, spans."""
    found = with_spans(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"))
