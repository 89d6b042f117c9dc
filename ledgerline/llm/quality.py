r"""Quality rules as a short-circuit cascade (operator 3), in DataFrame and
SQL functions only.

A rule rejects a document by a predicate over named features of its text
(``FEATURES``). The cascade estimates on a sample what each rule costs and
which share it rejects, orders the rules by rejection per cost, and then
computes a rule's features only for documents that every earlier rule let
pass. The order changes the work, never the verdict: a document is kept if
no rule rejects it.

Defined cases: a null or empty text has no words and fails ``few_words``;
repeated rows are judged each on their own; an empty table gives an empty
result; columns of the input pass through unchanged, whatever their names
(working columns start with ``__q_``).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES

#: The counted symbols and the window of repeated words.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

_SPACE_CLASS = r"[\\x20\\x09-\\x0D]+"


def _without(column: str, chars: str) -> str:
    """SQL for ``column`` with every one of ``chars`` deleted."""
    out = column
    for c in chars:
        lit = f"'{c}'" if c.isprintable() else f"char({ord(c)})"
        out = f"replace({out}, {lit})"
    return out


def _count_of(chars: str) -> str:
    return f"char_length(__q_text) - char_length({_without('__q_text', chars)})"


_WINDOW_HASH = ", ".join(f"__q_hashes[i + {k}]" for k in range(WINDOW))
#: Positions whose window occurs again, in order; then the words they cover.
_REPEATED = f"""
CASE WHEN size(array_distinct(__q_windows)) = size(__q_windows) THEN 0L ELSE
  aggregate(
    array_sort(flatten(transform(
      array(array_sort(transform(__q_windows, (h, i) -> struct(h AS h, i AS i)))),
      s -> transform(
        filter(s, (x, j) -> (j > 0 AND get(s, j - 1).h = x.h)
                            OR (j < size(s) - 1 AND get(s, j + 1).h = x.h)),
        x -> x.i)))),
    struct(-{WINDOW} AS last, 0L AS n),
    (a, i) -> struct(i AS last, a.n + least({WINDOW}, i - a.last) AS n),
    a -> a.n) END"""

#: name -> (features it is computed from, SQL over ``__q_<feature>``).
FEATURES: dict[str, tuple[tuple[str, ...], str]] = {
    "words": ((), f"array_remove(split(__q_text, '{_SPACE_CLASS}'), '')"),
    "n_words": (("words",), "CAST(size(__q_words) AS long)"),
    "word_chars": ((), f"CAST(char_length({_without('__q_text', SPACES)}) AS long)"),
    "n_symbols": ((), f"CAST({_count_of(SYMBOLS)} AS long)"),
    "n_bangs": ((), f"CAST({_count_of('!')} AS long)"),
    "lines": ((), r"filter(split(__q_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
    "n_lines": (("lines",), "CAST(size(__q_lines) AS long)"),
    "n_dup_lines": (("lines",), "CAST(size(__q_lines) - size(array_distinct(__q_lines)) AS long)"),
    "hashes": (("words",), "transform(__q_words, w -> xxhash64(w))"),
    "n_adjacent": (("hashes",), "CAST(size(filter(__q_hashes, (h, i) -> i > 0 AND "
                                "h = get(__q_hashes, i - 1))) AS long)"),
    "windows": (("hashes",), f"""CASE WHEN size(__q_hashes) < {WINDOW} THEN array()
        ELSE transform(sequence(0, size(__q_hashes) - {WINDOW}), i -> xxhash64({_WINDOW_HASH})) END"""),
    "n_repeat_words": (("windows",), _REPEATED),
}


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: str

    def condition(self) -> Column:
        return F.coalesce(F.expr(self.rejects), F.lit(False))


#: The first two are the base rules. Thresholds leave a wide gap to what
#: clean prose reaches in any of the corpus's languages.
RULES = (
    Rule("few_words", ("n_words",), "__q_n_words < 20"),
    Rule("repeated_windows", ("n_words", "n_repeat_words"),
         "100 * __q_n_repeat_words > 30 * __q_n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * __q_n_symbols > __q_n_words"),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), "2 * __q_n_dup_lines > __q_n_lines"),
    Rule("word_length", ("n_words", "word_chars"),
         "__q_word_chars < 2 * __q_n_words OR __q_word_chars > 15 * __q_n_words"),
    Rule("shouting", ("n_words", "n_bangs"), "2 * __q_n_bangs > __q_n_words"),
    Rule("adjacent_words", ("n_words", "n_adjacent"), "5 * __q_n_adjacent > __q_n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class RuleEstimate:
    name: str
    seconds: float
    rejected: float


def _with_features(df: DataFrame, names, done: set[str], guard: Column | None) -> DataFrame:
    for name in names:
        if name in done:
            continue
        needs, sql = FEATURES[name]
        df = _with_features(df, needs, done, guard)
        value = F.expr(sql)
        df = df.withColumn(f"__q_{name}", value if guard is None else F.when(guard, value))
        done.add(name)
    return df


def estimate_rules(docs: DataFrame, rules=RULES, sample_rows: int = 500,
                   sample_chars: int = 20_000) -> list[RuleEstimate]:
    """Time and rejected share of each rule on a sample: ``sample_rows``
    documents of the first partitions, long ones by their first
    ``sample_chars`` characters. It steers the order only."""
    spark = docs.sparkSession
    rows = docs.select(F.substring("text", 1, sample_chars).alias("__q_text")).take(sample_rows)
    if not rows:
        return [RuleEstimate(r.name, 1.0, 0.0) for r in rules]
    sample = spark.createDataFrame(rows, "__q_text string").withColumn(
        "__q_text", F.coalesce("__q_text", F.lit(""))).coalesce(1).cache()
    out = []
    try:
        sample.count()
        for rule in rules:
            judged = _with_features(sample, rule.needs, set(), None).select(
                F.avg(rule.condition().cast("double")))
            judged.collect()
            began = time.perf_counter()
            share = judged.collect()[0][0]
            out.append(RuleEstimate(rule.name, max(time.perf_counter() - began, 1e-4), share))
    finally:
        sample.unpersist()
    return out


def order_rules(rules, estimates: list[RuleEstimate]) -> list[Rule]:
    """Most rejection per cost first; ties by name."""
    gain = {e.name: e.rejected / e.seconds for e in estimates}
    cost = {e.name: e.seconds for e in estimates}
    return sorted(rules, key=lambda r: (-gain[r.name], cost[r.name], r.name))


def judge(docs: DataFrame, rules=RULES, report: tuple[str, ...] = (),
          order: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``__q_kept``, and ``__q_<feature>`` for each reported
    feature (those are computed for every document)."""
    order = order or order_rules(rules, estimate_rules(docs, rules))
    df = docs.withColumn("__q_text", F.coalesce(F.col("text"), F.lit("")))
    done: set[str] = set()
    df = _with_features(df, report, done, None)
    alive = None
    for rule in order:
        df = _with_features(df, rule.needs, done, alive)
        passed = ~rule.condition()
        df = df.withColumn("__q_kept", passed if alive is None else alive & passed)
        alive = F.col("__q_kept")
    if not order:
        return df.withColumn("__q_kept", F.lit(True))
    # A generator keeps filters on the verdict above the cascade: pushed
    # below, they would inline, and so repeat, every shared feature.
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "__q_kept"],
                     F.explode(F.array("__q_kept")).alias("__q_kept"))


def keep(docs: DataFrame, rules=RULES, order: list[Rule] | None = None) -> DataFrame:
    """The documents that no rule rejects, with the input's columns."""
    return judge(docs, rules, order=order).where("__q_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_report(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the base features, ``base_failed`` and ``kept`` of every row."""
    features = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge(docs.select("doc_id", "text"), rules, report=features)
    failed = F.lit(False)
    for rule in rules:
        if rule.name in BASE:
            failed = failed | rule.condition()
    return judged.select("doc_id", *[F.col(f"__q_{f}").alias(f) for f in features],
                         failed.alias("base_failed"), F.col("__q_kept").alias("kept"))
