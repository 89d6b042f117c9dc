"""Token ids in a binary file format (operator 1).

Texts are encoded, ordered by doc_id and written as shards:

* ``dictionary.zdict``: one zstandard dictionary for all shards, trained on
  the serialized ids of a bounded sample (``DictionarySample``).
* ``shard-*.bin``: one zstandard frame per document, back to back. A frame
  holds the document's ids as little-endian unsigned integers of
  ``id_width`` bytes, the end id last.
* ``shard-*.idx``: a JSON header line (format, id width, SHA-256 of the
  dictionary, counts), then int64 columns: doc_id, null flag of doc_id,
  frame offset (n + 1 values), token offset in the shard (n + 1 values).
* ``manifest``: a Parquet table, one row per shard. A task's row is
  committed by Spark, so a shard left by a lost or repeated attempt is in
  no manifest and never read.

Defined cases: a null or empty text is a document of the end id alone; a
null doc_id sorts first; rows that share a doc_id each keep a frame, in the
order of their texts; an empty table gives no shard and an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Kept, open_fs, small_batches, worker_state

FORMAT = "token-shard-1"
NO_DICTIONARY = "0" * 64
#: Marks that end many words; the pre-tokenizer parts them from letters.
MARKS = (".", ",", "!", "?", ":", ";")
#: Distinct words of either generation (see ``Kept``) whose ids a Python
#: worker keeps; it changes time, not results.
CACHE_WORDS = 150_000
#: Text bytes that are encoded at once in a task, and rows of the batches
#: they come in.
ENCODE_BYTES, ENCODE_ROWS = 2 << 20, 500
#: Characters of the text that divide the rows of one doc_id among tasks.
PLACE_CHARS = 48
READ_BYTES = 4 << 20

MANIFEST_SCHEMA = ("shard long, name string, n_docs long, n_tokens long, "
                   "first_doc long, last_doc long")
DIGEST_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class DictionarySample:
    """Bounds of the dictionary's training sample: how many documents, drawn
    by id hash from the first partitions, and how much of each text the
    training looks at. Only compression ratio depends on it."""

    documents: int = 512
    chars_each: int = 8192
    dictionary_bytes: int = 32768


@dataclass(frozen=True)
class TokenFormat:
    tokenizer: str
    end_id: int = 1
    id_width: int = 2
    level: int = 3


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes every byte as a printable letter: printable
    Latin-1 bytes as themselves, the rest as the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts, without end ids. The tokenizer never joins characters across ASCII white
    space and ignores ASCII case, so a text's ids are the ids of its
    lower-cased chunks in turn; it also parts letters from punctuation.
    Chunks are dictionary-encoded in Arrow, and each distinct one goes to the
    tokenizer once per worker: plain lower-case Latin words straight to its
    model, anything else through its whole pipeline."""

    def __init__(self, fmt: TokenFormat):
        # Spark runs a task per core; the tokenizer's threads would each keep
        # memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.dtype = np.dtype(f"<u{fmt.id_width}")
        self.code = {1: "B", 2: "H", 4: "I"}[fmt.id_width]
        self.tokenizer = Tokenizer.from_file(fmt.tokenizer)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.kept = Kept()
        self.marked = {m: self._pack(self.tokenizer.encode(m, add_special_tokens=False).ids) for m in MARKS}
        # Special tokens are matched before lower-casing.
        self.marks = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        known, old, tokenize, code, whole = self.kept.young, self.kept.old, self.model.tokenize, self.code, []
        for chunk in chunks:
            mark = chunk[-1] if chunk[-1:] in MARKS else ""
            core = chunk[:-1] if mark else chunk
            # Below U+0250 letters are in composed form already.
            plain = core.isascii()
            if core.isalpha() and core.islower() and (plain or max(core) < "\u0250"):
                # A run of letters that needs no normalising.
                ids = (known.get(core) or old.get(core)) if mark else None
                if ids is None:
                    letters = core if plain else core.encode("utf-8").decode("latin-1").translate(self.letters)
                    ids = array(code, [t.id for t in tokenize(letters)]).tobytes()
                    if mark:
                        known[core] = ids
                known[chunk] = ids + self.marked[mark] if mark else ids
            else:
                whole.append(chunk)
        for k in range(0, len(whole), 4096):
            part = whole[k:k + 4096]
            for chunk, enc in zip(part, self.tokenizer.encode_batch_fast(
                    part, add_special_tokens=False), strict=True):
                known[chunk] = self._pack(enc.ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, offsets of each text's ids)."""
        import pyarrow.compute as pc

        if texts.offset:  # pyarrow's ascii_lower misreads a slice
            texts = pa.array(texts.to_pylist(), pa.large_string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lower = pc.ascii_lower(texts)
        for mark in self.marks:
            lower = pc.if_else(pc.match_substring(texts, mark), texts, lower)
        chunked = pc.ascii_split_whitespace(lower)
        coded = chunked.flatten().dictionary_encode()
        self.kept.age(CACHE_WORDS)
        self.kept.young[""] = b""
        packed = self.kept.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._learn)
        sizes = np.fromiter(map(len, packed), np.int32, len(packed)) // self.dtype.itemsize
        table = np.frombuffer(b"".join(packed), self.dtype)
        # Lay the chunks' ids end to end.
        codes = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        small = np.int32 if max(ends[-1], len(table)) < 1 << 30 else np.int64
        place = np.repeat(((np.cumsum(sizes, dtype=np.int64) - sizes)[codes] - ends[:-1]).astype(small), n)
        place += np.arange(ends[-1], dtype=small)
        ids = table[place]
        offsets = chunked.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]


def worker_encoder(fmt: TokenFormat) -> Encoder:
    state = worker_state()
    if state.get("encoder_of") != fmt:
        state.update(encoder_of=fmt, encoder=Encoder(fmt))
    return state["encoder"]


def train_dictionary(docs: DataFrame, fmt: TokenFormat, sample: DictionarySample) -> bytes:
    """The shared dictionary, from a sample bounded in rows and characters
    (empty if the corpus is too small to train one). A task trains it, so that
    the driver needs no encoder."""
    spark = docs.sparkSession

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        ids, ends = worker_encoder(fmt).encode(pa.array(texts, pa.string()))
        samples = [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True) if b - a > 8]
        try:
            trained = zstd.train_dictionary(sample.dictionary_bytes, samples, k=128, d=8).as_bytes()
        except (zstd.ZstdError, ValueError):
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    # A share by id hash that holds some times the wanted rows, so that
    # reading stops after the first partitions.
    share = min(1.0, 8 * sample.documents / max(1, docs.count()))
    rows = (docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
            .select(F.substring("text", 1, sample.chars_each).alias("_t"))
            .limit(sample.documents).collect())
    if not rows:
        return b""
    texts = spark.createDataFrame(rows, "_t string").coalesce(1)
    return bytes(texts.mapInArrow(train, "dictionary binary").first()[0])


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Non-empty batches, small ones joined up to ``size`` bytes."""
    held, held_bytes = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            held_bytes += batch.nbytes
        if held_bytes >= size:
            yield pa.concat_batches(held)
            held, held_bytes = [], 0
    if held:
        yield pa.concat_batches(held)


def write_tokens(docs: DataFrame, folder: str, fmt: TokenFormat,
                 sample: DictionarySample = DictionarySample()) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder``; returns the manifest."""
    import zstandard as zstd

    spark = docs.sparkSession
    small_batches(spark, ENCODE_ROWS)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, fmt, sample)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else NO_DICTIONARY
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/dictionary.zdict") as out:
        out.write(dictionary)

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(fmt)
        zdict = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstd.ZstdCompressor(level=fmt.level, dict_data=zdict, write_content_size=True)
        end = np.array([fmt.end_id], encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        fs, path = open_fs(folder)
        name, out = f"shard-{shard:07d}-{uuid.uuid4().hex[:12]}", None
        ids, nulls, offsets, starts = [], [], [0], [0]
        for batch in _gathered(batches, ENCODE_BYTES):
            out = out or fs.open_output_stream(f"{path}/{name}.bin")
            column = batch.column("doc_id")
            ids.append(column.fill_null(0).to_numpy(zero_copy_only=False))
            nulls.append(column.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
            tokens, ends = encoder.encode(batch.column("text"))
            starts += (ends[1:] + np.arange(1, len(ends)) + starts[-1]).tolist()
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                frame = pack.compress(tokens[a:b].tobytes() + end)
                out.write(frame)
                offsets.append(offsets[-1] + len(frame))
            # Workers stay for the tasks that follow; what Arrow holds free
            # would count in each of them.
            pa.default_memory_pool().release_unused()
        if out is None:
            return
        out.close()
        doc_ids, null = np.concatenate(ids), np.concatenate(nulls)
        head = {"format": FORMAT, "id_width": fmt.id_width, "end_id": fmt.end_id,
                "dictionary_sha256": digest, "n_docs": len(doc_ids), "n_tokens": starts[-1]}
        with fs.open_output_stream(f"{path}/{name}.idx") as idx:
            idx.write(json.dumps(head).encode() + b"\n")
            for values in (doc_ids, null, offsets, starts):
                idx.write(np.asarray(values, "<i8").tobytes())
        known = doc_ids[null == 0]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "name": [name],
            "n_docs": pa.array([len(doc_ids)], pa.int64()),
            "n_tokens": pa.array([starts[-1]], pa.int64()),
            "first_doc": pa.array([int(known[0]) if len(known) else None], pa.int64()),
            "last_doc": pa.array([int(known[-1]) if len(known) else None], pa.int64())})

    # A doc_id of any number of rows is divided by how its texts begin.
    (docs.repartitionByRange("doc_id", F.substring("text", 1, PLACE_CHARS)).sortWithinPartitions("doc_id", "text")
     .mapInArrow(write_shard, MANIFEST_SCHEMA).write.parquet(f"{folder}/manifest"))
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")


class Shard:
    """An open shard: index in memory, frames read on demand."""

    def __init__(self, folder: str, name: str):
        import zstandard as zstd

        fs, path = open_fs(folder)
        with fs.open_input_stream(f"{path}/{name}.idx") as f:
            raw = f.read()
        head, body = raw.split(b"\n", 1)
        self.head = json.loads(head)
        if self.head["format"] != FORMAT:
            raise ValueError(f"{name}: not a {FORMAT} file")
        with fs.open_input_stream(f"{path}/dictionary.zdict") as f:
            dictionary = f.read()
        digest = hashlib.sha256(dictionary).hexdigest() if dictionary else NO_DICTIONARY
        if digest != self.head["dictionary_sha256"]:
            raise ValueError(f"{name}: written with another dictionary")
        n = self.head["n_docs"]
        values = np.frombuffer(body, "<i8")
        self.doc_ids, self.null = values[:n], values[n:2 * n]
        self.offsets, self.starts = values[2 * n:3 * n + 1], values[3 * n + 1:]
        self.dtype = np.dtype(f"<u{self.head['id_width']}")
        self._file = fs.open_input_file(f"{path}/{name}.bin")
        self._unpack = zstd.ZstdDecompressor(
            dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, row: int) -> np.ndarray:
        """One document: one seek, one frame."""
        at, end = int(self.offsets[row]), int(self.offsets[row + 1])
        return np.frombuffer(self._unpack.decompress(self._file.read_at(end - at, at)), self.dtype)

    def all_ids(self) -> Iterator[np.ndarray]:
        """Every document in turn, the file read in blocks."""
        row, n = 0, self.head["n_docs"]
        while row < n:
            last = int(np.searchsorted(self.offsets, self.offsets[row] + READ_BYTES, "right")) - 1
            last = min(max(last, row + 1), n)
            base = int(self.offsets[row])
            block = self._file.read_at(int(self.offsets[last]) - base, base)
            for k in range(row, last):
                yield np.frombuffer(self._unpack.decompress(
                    block[int(self.offsets[k]) - base:int(self.offsets[k + 1]) - base]), self.dtype)
            row = last


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of every row with this doc_id, without reading other frames."""
    found = []
    for r in (spark.read.parquet(f"{folder}/manifest")
              .where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
              .orderBy("shard").collect()):
        shard = Shard(folder, r["name"])
        rows = np.flatnonzero((shard.doc_ids == doc_id) & (shard.null == 0))
        found += [shard.ids(int(k)) for k in rows]
    return found


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Digest of each document from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32. One task per shard; what the
    driver handles is one manifest row per shard."""
    spark = manifest.sparkSession
    base, shards = 0, []
    for r in manifest.orderBy("shard").collect():
        shards.append((r["name"], base))
        base += r["n_tokens"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                name, first = shards[k]
                shard = Shard(folder, name)
                crc = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes())
                                   for ids in shard.all_ids()), np.int64, shard.head["n_docs"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, mask=shard.null != 0),
                     pa.array(first + shard.starts[:-1]), pa.array(np.diff(shard.starts)),
                     pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    ids = spark.range(0, len(shards), 1, max(1, len(shards)))
    return ids.mapInArrow(digest, DIGEST_SCHEMA)
