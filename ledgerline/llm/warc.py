r"""WARC archives: write pages, read them back by boundary chains (operator 4).

Writing. Payload digests are taken first; of the records with equal payloads
of at least ``MIN_REVISIT`` bytes that with the smallest page_id is a
response and the others revisit it. Pages then stream from their own
partitions into one archive per task, without shuffling payloads; only the
table of repeated digests is joined to them. A manifest row per archive is
committed by Spark, so files of lost attempts are never read.

Reading. Archives are cut into blocks of bytes. A task finds every place in
its block that looks like a record's start, reads the length there and
notes the place's successor, the start that would follow; in a block the
successors are already chained up to the first place beyond it. Starting at
offset 0 of each file, pointer jumping (reached places are joined with the
jump table, the jump table with itself) finds where the true chain enters
each block, in a logarithmic number of rounds. Record magic inside a payload
is a place too, but no chain from the file's start reaches it; one whose
record would end beyond the file is no place. Each entry's chain is then read
record by record.

Defined cases: a null html is an empty payload; a null url is left out; a
row without page_id is a revisit if its payload has a response, and else a
response; rows that share the smallest page_id are all responses; an empty
table gives one archive per task without pages and an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import open_fs, small_batches, stored

MIN_REVISIT = 100
#: The record magic and the revisit profile of the format.
MAGIC = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Header names are short; a start whose head has no end within this many
#: bytes is read on until it has one or the file ends.
HEAD_BYTES = 1 << 14
#: Tasks that read archives at once; past it, a task reads several blocks.
MAX_TASKS = 50_000
BLOCK_BYTES = 8 << 20
#: Fixed value: lengths of more digits may not fit an offset of 64 bits.
LENGTH_DIGITS = 18
#: Rows of the digest table up to which it is broadcast (some 100 bytes each).
BROADCAST_DIGESTS = 200_000

MANIFEST = "name string, bytes long, records long"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, payload binary")


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return MAGIC + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None, revisit: bool, date: str) -> bytes:
    target = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date),
               ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("X-Page-Id", page_id)]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)),
                    ("X-Refers-To-Page-Id", refers_to), ("X-Payload-Length", len(payload))]
        return _record(headers, b"")
    return _record([*headers, ("Content-Type", "application/http;msgtype=response")],
                   HTTP_HEAD % len(payload) + payload)


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html); returns the
    manifest of the archives in ``folder``."""
    spark = pages.sparkSession
    small_batches(spark)
    pages = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                          F.coalesce("html", F.lit("")).alias("html"))
             .withColumn("digest", F.sha2("html", 256)))
    repeated = stored(
        pages.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-repeated")
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    rows = (pages.join(repeated, "digest", "left")
            .select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest",
                    "first", revisit.alias("revisit")))
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        name = f"pages-{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex[:12]}.warc"
        info = b"software: ledgerline\r\nformat: WARC File Format 1.1\r\n"
        size = n = 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            head = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                            ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info)
            out.write(head)
            size += len(head)
            for batch in batches:
                for page_id, url, html, digest, first, again in zip(
                        *(batch.column(k).to_pylist() for k in range(6)), strict=True):
                    record = page_record(page_id, url, html, digest, first, again, date)
                    out.write(record)
                    size, n = size + len(record), n + 1
        yield pa.RecordBatch.from_pydict({"name": [name], "bytes": [size], "records": [n]})

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _head(read, at: int, limit: int) -> tuple[dict[str, str], int] | None:
    """(headers, offset of the record's block) of the start at ``at``, or
    None if there is no well-formed head."""
    want = HEAD_BYTES
    while True:
        data = read(at, min(want, limit - at))
        end = data.find(b"\r\n\r\n", len(MAGIC) - 2)
        if end >= 0 or at + len(data) >= limit:
            break
        want *= 4
    if not data.startswith(MAGIC) or end < 0:
        return None
    headers = {}
    for line in data[len(MAGIC):end].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdecimal()):
        return None
    headers["content-length"] = length.lstrip("0") or "0"
    if len(headers["content-length"]) > LENGTH_DIGITS:
        return None
    return headers, at + end + 4


class _Block:
    """Reads of a file through one buffer that starts at a block."""

    def __init__(self, file, begin: int, size: int):
        self.file, self.begin = file, begin
        self.data = file.read_at(size, begin)

    def __call__(self, at: int, size: int) -> bytes:
        k = at - self.begin
        if 0 <= k and k + size <= len(self.data):
            return self.data[k:k + size]
        return self.file.read_at(size, at)


def _starts(file, begin: int, end: int, limit: int) -> list[tuple[int, int]]:
    """(offset, first chained place outside the block) of every place in
    [begin, end) that looks like a record start."""
    block = _Block(file, begin, min(end + HEAD_BYTES, limit) - begin)
    places, k = [], block.data.find(MAGIC)
    while 0 <= k < end - begin:
        places.append(begin + k)
        k = block.data.find(MAGIC, k + 1)
    leaves: dict[int, int] = {}
    for at in reversed(places):
        head = _head(block, at, limit)
        if head is None:
            continue
        follows = head[1] + int(head[0]["content-length"]) + 4
        if follows > limit:
            continue
        # A place that follows inside the block but isn't one ends the chain
        # there; reading it is an error if the chain is the true one.
        leaves[at] = leaves.get(follows, follows)
    return list(leaves.items())


def _tasks(manifest: DataFrame, block_bytes: int) -> int:
    """Partitions for rows that each stand for a block to be read. A number
    given by us is kept; AQE would merge them by the bytes of the rows."""
    blocks = F.sum(F.ceil(F.greatest("bytes", F.lit(1)) / block_bytes))
    return max(1, min(int(manifest.agg(blocks).first()[0] or 1), MAX_TASKS))


def chain_entries(manifest: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(name, bytes, offset): where the chain from each file's start enters
    the file's blocks. A true chain that breaks leads to an entry that is no
    record, which reading reports."""
    blocks = manifest.select("name", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.greatest("bytes", F.lit(1)) - 1) / block_bytes))).alias("block"))
    blocks = blocks.repartition(_tasks(manifest, block_bytes), "name", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        for batch in batches:
            for name, size, block in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                begin = block * block_bytes
                with fs.open_input_file(f"{path}/{name}") as file:
                    found = _starts(file, begin, min(begin + block_bytes, size), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([size] * len(found), pa.int64()),
                     pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())],
                    ["name", "bytes", "offset", "leaves"])

    places = stored(blocks.mapInArrow(run, "name string, bytes long, offset long, leaves long"),
                    "warc-places")
    # Only places that some chain leads to can be entries.
    led = places.where("leaves < bytes").select("name", F.col("leaves").alias("offset")).distinct()
    jumps = places.join(led, ["name", "offset"], "left_semi").select("name", "offset", "leaves")
    start = manifest.where("bytes > 0").select("name", "bytes", F.lit(0).cast("long").alias("offset"))
    first = (start.join(places.select("name", "offset", "leaves"), ["name", "offset"])
             .where("leaves < bytes").select("name", "bytes", F.col("leaves").alias("offset")))
    reached = start.unionByName(first)
    most = manifest.agg(F.max("bytes")).first()[0] or 1
    rounds = math.ceil(math.log2(-(-most // block_bytes))) if most > block_bytes else 0
    for _ in range(rounds):
        further = (reached.join(jumps, ["name", "offset"]).where("leaves < bytes")
                   .select("name", "bytes", F.col("leaves").alias("offset")))
        reached = reached.unionByName(further).distinct().checkpoint()
        onward = jumps.select("name", F.col("offset").alias("leaves"), F.col("leaves").alias("to"))
        jumps = (jumps.join(onward, ["name", "leaves"]).select("name", "offset", F.col("to").alias("leaves"))
                 .checkpoint())
    return reached


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The page records of all archives. payload_bytes and payload_digest of
    a response are measured on what the file holds."""
    entries = chain_entries(manifest, folder, block_bytes).repartition(
        _tasks(manifest, block_bytes), "name", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        for batch in batches:
            for name, size, at in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with fs.open_input_file(f"{path}/{name}") as file:
                    rows = _read_chain(file, at, min((at // block_bytes + 1) * block_bytes, size),
                                       size, with_payload)
                    for k in range(0, len(rows), 500):
                        yield pa.RecordBatch.from_pylist(rows[k:k + 500], _ROWS)

    return entries.select("name", "bytes", "offset").mapInArrow(run, RECORDS)


_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read_chain(file, at: int, end: int, limit: int, with_payload: bool) -> list[dict]:
    block, rows = _Block(file, at, end - at), []
    while at < end:
        head = _head(block, at, limit)
        if head is None:
            raise ValueError(f"no record at offset {at}")
        headers, body_at = head
        length = int(headers["content-length"])
        if body_at + length + 4 > limit:
            raise ValueError(f"record at offset {at} ends beyond the file")
        body = block(body_at, length)
        if block(body_at + length, 4) != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} doesn't end where its length says")
        at = body_at + length + 4
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        number = lambda key: int(headers[key]) if key in headers else None
        row = {"page_id": number("x-page-id"), "url": headers.get("warc-target-uri"),
               "record_type": kind, "refers_to": number("x-refers-to-page-id"), "payload": None}
        if kind == "response":
            payload = body[body.index(b"\r\n\r\n") + 4:]
            row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(),
                    "payload": payload if with_payload else None}
        else:
            row |= {"payload_bytes": number("x-payload-length"),
                    "payload_digest": headers["warc-payload-digest"].removeprefix("sha256:")}
        rows.append(row)
    return rows
