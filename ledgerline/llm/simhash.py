r"""SimHash near-duplicates by pigeonhole blocks (operator 6).

Texts are lower-cased in A-Z, cut into words of non-white-space and into
word shingles (repeats included; a text of fewer words is one shingle). A
fingerprint bit is 1 if it is set in over half the shingles' XXH64 values.
Fingerprints that differ in at most ``max_bits`` bits are linked, and the
connected components are the near-duplicate groups.

Search. The 64 bits are cut into ``max_bits + 2`` blocks; two close
fingerprints agree on at least two of them, so each distinct fingerprint is
filed under every pair of blocks, and members of a bucket are joined and
verified by Hamming distance. Copies share a fingerprint and are filed
once. A bucket above ``MAX_BUCKET`` is never joined: its members are filed
again by pairs of blocks of the bits that the bucket leaves open, until the
open bits allow no more than ``MAX_BUCKET`` values. That is exact, because a
close pair in a bucket differs only in the open bits and the same argument
holds for them; no candidate is capped or dropped.

Components. Each fingerprint has at most C(64,1) + C(64,2) neighbours, so
neighbour joins have no hot key; labels also jump to their label's label,
and each round is checkpointed.

Defined cases: a text without words (null, empty) has fingerprint zero and
links like any other; a null doc_id counts as larger than any id, and a
group of null ids only has a null component_id; repeated rows are copies;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches, stored

BITS = 64
SEED = 42
#: Members of a bucket that are compared directly; a work bound only.
MAX_BUCKET = 256


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle of a UTF-8 text."""
    import xxhash

    words = text.lower().split()  # bytes: lower-cases A-Z only, splits on ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[:1 - width], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in
                     zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half the values, as an unsigned integer."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k:k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's bits as a signed long) of
    every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(shingle_hashes(t or b"", width)) for t in texts],
                           np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())],
                ["doc_id", "text_hash", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pair_masks(open_bits: list[int], max_bits: int) -> list[list[int]]:
    """The bits of every two of max_bits + 2 blocks of ``open_bits``."""
    n = max_bits + 2
    blocks = [open_bits[k * len(open_bits) // n:(k + 1) * len(open_bits) // n] for k in range(n)]
    return [a + b for a, b in combinations(blocks, 2)]


def _levels(max_bits: int) -> list[dict[int, list[int]]]:
    """Per level: mask of a bucket -> masks of the buckets it splits into."""
    levels, masks = [], [0]
    while masks:
        split = {}
        for mask in masks:
            open_bits = [b for b in range(BITS) if not mask >> b & 1]
            if 1 << len(open_bits) > MAX_BUCKET:
                split[mask] = [mask | sum(1 << b for b in extra)
                               for extra in _pair_masks(open_bits, max_bits)]
        if split:
            levels.append(split)
        masks = sorted({m for ms in split.values() for m in ms})
    return levels


def close_pairs(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) with a < b: the distinct fingerprints ``nodes.fp`` that differ
    in 1 to ``max_bits`` bits."""
    spark = nodes.sparkSession
    filed = nodes.select("fp", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("key"))
    found = None
    for level, split in enumerate(levels := _levels(max_bits)):
        masks = spark.createDataFrame(
            [(_signed(m), [_signed(x) for x in xs]) for m, xs in split.items()],
            "mask long, next array<long>")
        if level == 0:
            nexts = F.array(*[F.lit(_signed(x)).cast("long") for x in split[0]])
            rows = filed.select("fp", F.explode(nexts).alias("mask"))
        else:  # the table has one row per mask, a few hundred at most
            rows = filed.join(F.broadcast(masks), "mask").select("fp", F.explode("next").alias("mask"))
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        if level:
            rows = rows.distinct()  # a pair of blocks may be reached by several ways
        last = level == len(levels) - 1
        crowded = None
        if not last:
            sizes = rows.groupBy("mask", "key").count().where(F.col("count") > MAX_BUCKET)
            crowded = stored(sizes.select("mask", "key"), f"simhash-crowded{level}")
            if crowded.isEmpty():
                crowded = None
        direct = rows if crowded is None else rows.join(crowded, ["mask", "key"], "left_anti")
        left = direct.withColumnRenamed("fp", "a")
        right = direct.withColumnRenamed("fp", "b")
        pairs = (left.join(right, ["mask", "key"])
                 .where((F.col("a") < F.col("b"))
                        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
                 .select("a", "b"))
        found = pairs if found is None else found.unionByName(pairs)
        if crowded is None:
            break
        filed = rows.join(crowded, ["mask", "key"], "left_semi")
    return found.distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node -> label, the smallest node of its component, for every node
    that occurs in ``pairs`` (a, b)."""
    links = stored(pairs.select(F.col("a").alias("node"), F.col("b").alias("other"))
                   .unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))),
                   "links")
    labels = (links.groupBy("node").agg(F.min("other").alias("m"))
              .select("node", F.least("node", "m").alias("label"))).checkpoint()
    while True:
        near = (links.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        hooked = (labels.join(near, "node")
                  .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = (hooked.join(jump, "label")
               .select("node", "old", F.least("label", "further").alias("label"))).checkpoint()
        if new.where("old != label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _first(doc_id: Column, text_hash: Column) -> Column:
    """Order of a group's rows: known ids first, then id, then text."""
    return F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"),
                    text_hash.alias("text_hash"))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, text_hash, fp and ``first`` (the smallest row of the group, as
    a struct) of every row."""
    marked = stored(fingerprints(docs, width), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(
        F.min(_first(F.col("doc_id"), F.col("text_hash"))).alias("first")), "fingerprint-nodes")
    labels = components(close_pairs(nodes.select("fp"), max_bits))
    grouped = (nodes.join(labels.withColumnRenamed("node", "fp"), "fp")
               .select("fp", "label", "first"))
    # Written tables on both sides of a join leave it to AQE to split a hot
    # group: a large component, or a fingerprint with many copies.
    heads = stored(grouped.groupBy("label").agg(F.min("first").alias("head")), "fingerprint-heads")
    linked = stored(grouped, "fingerprint-groups").join(heads, "label").select("fp", "head")
    per_fp = stored(nodes.join(linked, "fp", "left")
                    .select("fp", F.coalesce("head", "first").alias("first")), "fingerprint-first")
    return marked.join(per_fp, "fp").select("doc_id", "text_hash", "fp", "first")


def simhash_report(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    found = near_duplicates(docs.select("doc_id", "text"), width, max_bits)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("first.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each group stays: the one of the smallest doc_id (null
    last), of equal ids that with the smallest text hash."""
    found = near_duplicates(docs.select("doc_id", "text"), width, max_bits)
    none = F.lit(-(1 << 63))
    heads = (found.where(_first(F.col("doc_id"), F.col("text_hash")) == F.col("first"))
             .select(F.coalesce("doc_id", none).alias("__s_id"), F.col("text_hash").alias("__s_text"))
             .distinct())
    keyed = (docs.withColumn("__s_id", F.coalesce(F.col("doc_id").cast("long"), none))
             .withColumn("__s_text", F.xxhash64("text")))
    return (keyed.join(heads, ["__s_id", "__s_text"], "left_semi")
            .dropDuplicates(["__s_id", "__s_text"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
