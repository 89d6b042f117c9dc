r"""Mixing sources to target weights (operator 7), in DataFrame and SQL
functions only.

1. Sizes and targets. A document's size is its number of words. Sources, in
   code point order with null last, weigh 1, 2, 3, 1, 2, 3, ...; they share
   ``share`` of all words by weight, no source gets more than ``max_repeat``
   times its own words, and what a capped source cannot take is shared anew.
2. Blocks. A document's hash puts it at a place of its source's random
   order; equal ranges of that order are the source's blocks. Blocks and
   shards grow in number with the words: a shard of ``shard_words`` words
   is made of about ``shard_draws`` draws of blocks at any size.
   A target of f times the source and a rest is f draws of every block and
   one more draw of blocks in a permuted order until the rest is met; the
   block at the edge is cut by sub-block, and the sub-block at the edge by
   document.
3. Shards. The block quotas of all sources go down a binary tree: each node
   hands half of its draws to the left by a multivariate hypergeometric
   draw, the others to the right. The leaves are the shards and hold exact
   quotas; a source without draws in a node is not in its table. Nodes of
   more than ``NODE_DRAWS`` draws are split as tables of draws (those of the
   smallest hashes go left), the smaller ones below them row by row
   (selection sampling over the quotas).
4. Each source's draws, permuted, are dealt to the shards by their quotas,
   so no two shards share a draw, and every shard is shuffled locally.

Running sums within a source go over slices of its order first and then
within each slice, so that a source of n blocks meets in windows of about
sqrt(n) rows. Only the targets run over all sources in one window, a row
of a few numbers each.

All randomness is a hash of ``seed`` and ids, so reruns agree.

Defined cases: a null text has size 0; a source of size 0 has target 0; a
null source is a source of its own; repeated rows count and are drawn each;
an empty table gives an empty result; columns pass through unchanged
(working columns start with ``__m_``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, stored

#: Sources up to which the tables by source are broadcast, and the estimated
#: bytes up to which these and the table by block are; beyond that they are
#: joined by shuffle.
BROADCAST_SOURCES = 50_000
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 256
SUB_BLOCKS = 2048
#: Draws of a tree node that one row may hold.
NODE_DRAWS = 1 << 17


@dataclass(frozen=True)
class Mix:
    share: float = 1.0
    max_repeat: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    shard_draws: int = 64
    block_documents: int = 64
    shard_words: int = 4_000_000
    min_shards: int = 64
    seed: int = 7


_SOURCE = ["__m_none", "__m_source"]
_EDGE = [*_SOURCE, "__m_block"]


def _placed(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with the source key and the place hash of each row."""
    return (docs.withColumn("__m_none", F.col("source").isNull())
            .withColumn("__m_source", F.coalesce(F.col("source").cast("string"), F.lit("")))
            .withColumn("__m_hash", F.xxhash64(F.lit(mix.seed), F.col("doc_id"), F.col("text"))))


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: __m_size, __m_target (words) and __m_blocks. The
    windows run over the sources, not over documents."""
    sources = sized.groupBy(*_SOURCE).agg(F.sum("__m_words").alias("__m_size"), F.count("*").alias("docs"))
    by_name, by_level = Window.orderBy(*_SOURCE), Window.orderBy("level", *_SOURCE)
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in mix.weights])
    rows = (sources
            .withColumn("w", F.get(weights, (F.row_number().over(by_name) - 1) % len(mix.weights)))
            .withColumn("all", F.sum("__m_size").over(everything))
            .withColumn("documents", F.sum("docs").over(everything))
            .withColumn("cap", F.lit(mix.max_repeat) * F.col("__m_size"))
            .withColumn("level", F.col("cap") / F.col("w")))
    # Raising one common level of words per unit of weight, sources reach
    # their caps in order of cap / weight; the first that does not sets it.
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("try", (F.col("all") * mix.share - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                           / F.sum("w").over(after))
    final = F.min_by(F.when(F.col("try") <= F.col("level"), F.col("try")),
                     F.when(F.col("try") <= F.col("level"),
                            F.struct("level", *_SOURCE))).over(everything)
    # shard_draws blocks to a shard, none below block_documents mean documents.
    words = F.greatest(F.lit(1), F.least(
        F.ceil(F.col("all") / (mix.min_shards * mix.shard_draws)),
        F.lit(max(1, mix.shard_words // mix.shard_draws))), F.ceil(
        F.col("all") * mix.block_documents / F.col("documents")))
    return (rows.withColumn("final", final)
            .select(*_SOURCE, "__m_size",
                    F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("w"),
                                                                    F.col("cap").cast("double")))
                    .alias("__m_target"),
                    F.greatest(F.lit(1), F.ceil(F.col("__m_size") / words)).cast("long").alias("__m_blocks"),
                    F.col("all").alias("__m_all")))


def _block() -> Column:
    """The range of the source's order that the row's hash falls into, and
    within it, by other bits of the hash, the sub-block."""
    place = F.shiftrightunsigned("__m_hash", 11) / F.lit(float(1 << 53))
    return F.floor(place * F.col("__m_blocks")).cast("long")


def _sub() -> Column:
    return F.col("__m_hash").bitwiseAND(F.lit(SUB_BLOCKS - 1))


def _joined(rows: DataFrame, small: DataFrame, keys: list[str], bounded: bool) -> DataFrame:
    return rows.join(F.broadcast(small) if bounded else small, keys)


@dataclass
class Plan:
    """Tables by source and by block (its draws and their shards, and where
    the source's edge lies in it), and which of them may be broadcast."""

    sources: DataFrame
    blocks: DataFrame
    few_sources: bool
    few_blocks: bool
    shards: int


def _before_edge() -> Column:
    """Within an edge block: the row comes before the edge."""
    return (F.coalesce(_sub() <= F.col("__m_last_sub"), F.lit(False))
            | F.coalesce((_sub() == F.col("__m_edge_sub"))
                         & (F.col("__m_hash") <= F.col("__m_last_hash")), F.lit(False)))


def _running(rows: DataFrame, value: str, place: Column, order: list[str], units: Column) -> DataFrame:
    """``rows`` with __m_through, the sum of ``value`` within the source up to
    the row in the order of ``order``. ``place`` (0 to 1) rises with that
    order and cuts a source of about ``units`` rows into slices."""
    slices = F.ceil(F.sqrt(units))
    rows = rows.withColumn("__m_slice", F.least(F.floor(place * slices), slices - 1).cast("long"))
    key = [*_SOURCE, "__m_slice"]
    earlier = Window.partitionBy(*_SOURCE).orderBy("__m_slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*key).agg(F.sum(value).alias("in_slice")).select(
        *key, F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("__m_earlier"))
    within = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(heads, key)
            .withColumn("__m_through", F.col("__m_earlier") + F.sum(value).over(within))
            .drop("__m_slice", "__m_earlier"))


def _place(hashed: str) -> Column:
    return F.col(hashed) / F.lit(float(1 << 64)) + 0.5


def _edge(units: DataFrame) -> DataFrame:
    """Mark the units that lie wholly within the source's rest, and the one
    at its edge with what is left for it."""
    return (units.withColumn("__m_whole", F.col("__m_through") <= F.col("__m_rest"))
            .withColumn("__m_left", F.col("__m_rest") - (F.col("__m_through") - F.col("__m_words")))
            .withColumn("__m_edge", ~F.col("__m_whole") & (F.col("__m_left") > 0)))


def build_plan(sized: DataFrame, mix: Mix) -> Plan:
    """``sized``: rows of source key, __m_hash and __m_words, written down."""
    sources = stored(
        targets(sized, mix)
        .withColumn("__m_full", F.when(F.col("__m_size") > 0, F.floor(F.col("__m_target") / F.col("__m_size")))
                    .otherwise(0).cast("long"))
        .withColumn("__m_rest", F.col("__m_target") - F.col("__m_full") * F.col("__m_size")),
        "mix-sources")
    row_bytes = F.octet_length("__m_source").cast("long") + ROW_BYTES
    head = sources.agg(F.count("*").alias("n"), F.max("__m_all").alias("all"), F.sum(row_bytes).alias("bytes"),
                       F.sum(row_bytes * F.col("__m_blocks")).alias("block_bytes")).first()
    bounded = head["n"] <= BROADCAST_SOURCES and (head["bytes"] or 0) <= BROADCAST_BYTES
    few_blocks = bounded and (head["block_bytes"] or 0) <= BROADCAST_BYTES
    shards = mix.min_shards
    while shards * mix.shard_words < (head["all"] or 0) * mix.share:
        shards *= 2
    in_blocks = _joined(sized, sources, _SOURCE, bounded).withColumn("__m_block", _block())
    sums = in_blocks.groupBy(*_SOURCE, "__m_block").agg(F.sum("__m_words").alias("__m_words"))
    ordered = _joined(stored(sums, "mix-sums"), sources, _SOURCE, bounded).withColumn(
        "__m_order", F.xxhash64(F.lit(mix.seed + 1), *_SOURCE, "__m_block"))
    blocks = stored(_edge(_running(ordered, "__m_words", _place("__m_order"), ["__m_order", "__m_block"],
                                   F.col("__m_blocks"))), "mix-blocks")
    # The source's edge block by sub-block, its edge sub-block by document.
    edge = blocks.where("__m_edge").select(*_SOURCE, "__m_block", F.col("__m_left").alias("__m_rest"))
    rows = (_joined(in_blocks.drop("__m_rest").select(*_SOURCE, "__m_block", "__m_hash", "__m_words"),
                    edge, _EDGE, bounded).withColumn("__m_sub", _sub()))
    # At most SUB_BLOCKS rows to a source.
    by_sub = Window.partitionBy(*_SOURCE).orderBy("__m_sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    subs = (_edge(rows.groupBy(*_EDGE, "__m_rest", "__m_sub").agg(F.sum("__m_words").alias("__m_words"))
                  .withColumn("__m_through", F.sum("__m_words").over(by_sub)))
            .groupBy(*_EDGE, "__m_rest")
            .agg(F.min(F.when(F.col("__m_edge"), F.col("__m_sub"))).alias("__m_edge_sub"),
                 F.max(F.when(F.col("__m_whole"), F.col("__m_sub"))).alias("__m_last_sub"),
                 F.max(F.when(F.col("__m_edge"), F.col("__m_left"))).alias("__m_sub_left")))
    rows = stored(_joined(rows.drop("__m_rest"), subs, _EDGE, bounded), "mix-edge")
    through = F.sum("__m_words").over(Window.partitionBy(*_SOURCE).orderBy("__m_hash"))
    fits = (rows.where("__m_sub = __m_edge_sub").withColumn("through", through)
            .where("through <= __m_sub_left").groupBy(*_EDGE)
            .agg(F.max("__m_hash").alias("__m_last_hash"), F.max("through").alias("fit")))
    rows = (_joined(rows, subs.select(*_EDGE).join(fits, _EDGE, "left"), _EDGE, bounded)
            .withColumn("gap", F.coalesce("__m_sub_left", F.lit(0.0)) - F.coalesce("fit", F.lit(0))))
    # Of the documents left in the block, the one that fills the gap best.
    cut = (rows.groupBy(*_EDGE, "__m_edge_sub", "__m_last_sub", "__m_last_hash")
           .agg(F.min_by("__m_hash", F.when(
               ~_before_edge() & (F.abs(F.col("gap") - F.col("__m_words")) < F.col("gap")),
               F.struct(F.abs(F.col("gap") - F.col("__m_words")), F.col("__m_hash"))))
               .alias("__m_fill_hash")))
    draws = _dealt(blocks, mix, shards)
    plan = (blocks.select(*_SOURCE, "__m_block", "__m_whole", "__m_edge", "__m_full")
            .join(cut, _EDGE, "left")
            .join(draws, _EDGE, "left"))
    return Plan(sources, stored(plan, "mix-plan"), bounded, few_blocks, shards)


#: Levels of the tree that one expression goes down: plans stay short, and a
#: row holds the draws of one node of the first of them.
LEVELS_AT_ONCE = 6

_LEFT = """
aggregate(t.quotas,
  struct(shiftright(t.total, 1) AS n, t.total AS rest, CAST(array() AS array<bigint>) AS went),
  (node_acc, s) -> element_at(transform(
    array(aggregate(IF(s.q = 0, CAST(array() AS array<bigint>), sequence(1L, s.q)),
      struct(node_acc.n AS n, node_acc.rest AS rest, 0L AS x),
      (a, i) -> IF(shiftrightunsigned(xxhash64({seed}, t.node, s.none, s.source, i), 11)
                     / 9007199254740992D * a.rest < a.n,
                   struct(a.n - 1L AS n, a.rest - 1L AS rest, a.x + 1L AS x),
                   struct(a.n AS n, a.rest - 1L AS rest, a.x AS x)))),
    d -> struct(d.n AS n, d.rest AS rest, concat(node_acc.went, array(d.x)) AS went)), 1),
  acc -> acc.went)"""

#: The two halves of each of ``nodes``.
_HALVES = f"""
flatten(transform(
  transform(transform(nodes, t -> struct(t.node AS node, t.quotas AS quotas,
                                         aggregate(t.quotas, 0L, (a, s) -> a + s.q) AS total)),
            t -> struct(t.node AS node, t.quotas AS quotas, {_LEFT} AS went)),
  t -> array(
    struct(2 * t.node AS node, transform(filter(transform(t.quotas, (s, k) ->
      struct(s.none AS none, s.source AS source, get(t.went, k) AS q, s.q = 0 AS stays)),
      s -> s.q > 0 OR s.stays), s -> struct(s.none AS none, s.source AS source, s.q AS q)) AS quotas),
    struct(2 * t.node + 1 AS node, filter(transform(t.quotas, (s, k) ->
      struct(s.none AS none, s.source AS source, s.q - get(t.went, k) AS q)), s -> s.q > 0) AS quotas))))"""


def _exploded(rows: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """A row per number from ``start`` to ``end``, in two steps so that no
    row holds a long array."""
    step = 4096
    return (rows.where(f"`{end}` >= `{start}`")
            .withColumn("part", F.explode(F.expr(f"sequence(`{start}`, `{end}`, {step}L)")))
            .withColumn(name, F.explode(F.sequence("part", F.least(F.col("part") + step - 1, F.col(end)))))
            .drop("part"))


def _split_large(tree: DataFrame, seed: int) -> DataFrame:
    """One level down for nodes of many draws: the half of a node's draws
    that has the smallest hashes goes left. Where that half ends is found in
    a histogram of the hashes and, in its last bar, draw by draw."""
    one = F.lit(1).cast("long")
    draws = (_exploded(tree.withColumn("first", one), "first", "q", "i")
             .select("node", "none", "source", F.xxhash64(F.lit(seed), "node", "none", "source", "i").alias("h"), "i")
             .withColumn("bar", F.shiftright("h", 48)))
    bars = Window.partitionBy("node").orderBy("bar").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (draws.groupBy("node", "bar").agg(F.count("*").alias("n"))
            .withColumn("through", F.sum("n").over(bars))
            .withColumn("half", F.shiftright(F.sum("n").over(Window.partitionBy("node")), 1))
            .where("through > half AND through - n <= half")
            .select("node", F.col("bar").alias("last"), (F.col("half") - F.col("through") + F.col("n")).alias("open")))
    draws = draws.join(ends, "node")
    in_bar = F.row_number().over(Window.partitionBy("node").orderBy("h", "none", "source", "i"))
    left = (draws.where("bar < last").select("node", "none", "source").unionByName(
        draws.where("bar = last").withColumn("rank", in_bar).where("rank <= open").select("node", "none", "source"))
        .groupBy("node", "none", "source").agg(F.count("*").alias("x")))
    x = F.coalesce("x", F.lit(0).cast("long"))
    return (tree.join(left, ["node", "none", "source"], "left")
            .select("none", "source", F.inline(F.array(
                F.struct((F.col("node") * 2).alias("node"), x.alias("q"), (F.col("q") == 0).alias("stays")),
                F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("q") - x).alias("q"), F.lit(False).alias("stays")))))
            .where("q > 0 OR stays").select("node", "none", "source", "q"))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(none, source, q) -> (shard, none, source, q) without rows of zero
    (a quota of zero goes to shard 0): at each node of a binary tree, a draw
    goes left with probability (left places open) / (draws left). That is a
    multivariate hypergeometric split, and the two halves always add up to
    the quotas."""
    total = quotas.agg(F.sum("q")).first()[0] or 0
    levels, level = shards.bit_length() - 1, 0
    flat = quotas.select(F.lit(0).cast("long").alias("node"), "none", "source", "q")
    while level < levels and total >> level > NODE_DRAWS:
        flat = stored(_split_large(flat, seed), "mix-tree")
        level += 1
    tree = flat.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("none", "source", "q"))).alias("quotas"))
    spread = level > 0
    while level < levels:
        if level == LEVELS_AT_ONCE and not spread:
            tree = tree.repartition("node")
        down = min(LEVELS_AT_ONCE, levels - level)
        tree = tree.select(F.inline(F.expr(
            f"aggregate(sequence(1, {down}), array(struct(node, quotas)), (nodes, l) -> {_HALVES.format(seed=seed)})")))
        level += down
    return tree.select(F.col("node").alias("shard"), F.inline("quotas"))


def _dealt(blocks: DataFrame, mix: Mix, shards: int) -> DataFrame:
    """Per block, its draws as (pass, shard): every full pass, and the last
    pass for blocks within the rest or at its edge. A source's draws have
    numbers in a permuted order, its shards take them in stretches of their
    quotas, and the two meet by number."""
    last = F.when(F.col("__m_whole") | F.col("__m_edge"), F.array("__m_full")).otherwise(
        F.array().cast("array<long>"))
    full = F.when(F.col("__m_full") > 0, F.sequence(F.lit(0).cast("long"), F.col("__m_full") - 1)).otherwise(
        F.array().cast("array<long>"))
    draws = (blocks.select(*_SOURCE, "__m_block", (F.col("__m_blocks") * (F.col("__m_full") + 1)).alias("units"),
                           F.explode(F.concat(full, last)).alias("pass"))
             .withColumn("one", F.lit(1).cast("long"))
             .withColumn("order", F.xxhash64(F.lit(mix.seed + 3), *_SOURCE, "__m_block", "pass")))
    quotas = draws.groupBy(*_SOURCE).agg(F.count("*").alias("q")).select(
        F.col("__m_none").alias("none"), F.col("__m_source").alias("source"), "q")
    leaves = split_quotas(quotas, shards, mix.seed + 2).select(
        F.col("none").alias("__m_none"), F.col("source").alias("__m_source"), "shard", "q")
    leaves = _running(stored(leaves, "mix-leaves"), "q", F.col("shard") / shards, ["shard"], F.lit(shards))
    taken = _exploded(leaves.select(*_SOURCE, "shard", (F.col("__m_through") - F.col("q") + 1).alias("from"),
                                    F.col("__m_through").alias("to")), "from", "to", "__m_through")
    draws = _running(draws, "one", _place("order"), ["order", "__m_block", "pass"], F.col("units"))
    return (draws.join(taken.drop("from", "to"), [*_SOURCE, "__m_through"])
            .groupBy(*_SOURCE, "__m_block")
            .agg(F.collect_list(F.struct("pass", "shard")).alias("__m_draws")))


def _with_draws(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` (placed) with their source's and block's plan and
    ``__m_partial``: whether the last pass takes the row too."""
    sources = plan.sources.select(*_SOURCE, "__m_size", "__m_target", "__m_blocks")
    rows = _joined(rows, sources, _SOURCE, plan.few_sources).withColumn("__m_block", _block())
    fills = F.coalesce(F.col("__m_hash") == F.col("__m_fill_hash"), F.lit(False))
    return _joined(rows, plan.blocks, _EDGE, plan.few_blocks).withColumn(
        "__m_partial", F.col("__m_whole") | (F.col("__m_edge") & (_before_edge() | fills)))


def _sized(docs: DataFrame, mix: Mix) -> DataFrame:
    return stored(_placed(docs.select("doc_id", "text", "source"), mix).select(
        F.col("doc_id"), *_SOURCE, "__m_hash", _size().alias("__m_words")), "mix-sizes")


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized = _sized(docs, mix)
    plan = build_plan(sized, mix)
    rows = _with_draws(sized, plan)
    copies = F.col("__m_full") + F.col("__m_partial").cast("long")
    return rows.select("doc_id", F.col("__m_words").alias("size"), F.col("__m_size").alias("source_size"),
                       F.col("__m_target").alias("target"),
                       (F.col("__m_words") * copies).alias("taken"))


def mixed(docs: DataFrame, mix: Mix = Mix(), with_shard: bool = False) -> DataFrame:
    """The mix: ``docs`` rows as often as they are drawn, in shards that are
    shuffled locally (``__m_shard`` on request)."""
    plan = build_plan(_sized(docs, mix), mix)
    rows = _with_draws(_placed(docs, mix), plan)
    draws = F.filter("__m_draws", lambda d: (d["pass"] < F.col("__m_full")) | F.col("__m_partial"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = rows.select(*columns, "__m_hash", F.explode(draws).alias("__m_draw"))
    out = (out.select(*columns, F.col("__m_draw.shard").alias("__m_shard"),
                      F.xxhash64(F.lit(mix.seed + 4), "__m_hash", "__m_draw.pass").alias("__m_turn"))
           .repartitionById(plan.shards, F.col("__m_shard").cast("int"))
           .sortWithinPartitions("__m_shard", "__m_turn"))
    return out.select(*columns, *(["__m_shard"] if with_shard else []))
