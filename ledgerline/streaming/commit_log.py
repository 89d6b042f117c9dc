"""The file sink's commit log: which files a streaming table consists of.

A micro-batch is stored when its log file is there, whatever happens to the
program afterwards, so counting from the log counts what was stored. Entries
are only ever added at the end: log ``n`` has those of batch ``n``, and
``n.compact`` those of all batches up to ``n``. The log is read whole, as
Spark does to list such a table.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import SparkSession

from ledgerline.storage import Store

LOG = "_spark_metadata"


def committed_files(spark: SparkSession, table: str) -> list[str]:
    """Paths of the committed files, in order of their commit."""
    store, folder = Store(spark), f"{table.rstrip('/')}/{LOG}"
    plain, compact = [], []
    for name in store.names(folder):
        number, _, kind = name.partition(".")
        if number.isdecimal() and kind in ("", "compact"):
            (compact if kind else plain).append(int(number))
    base = max(compact, default=-1)
    logs = ([f"{base}.compact"] if compact else []) + [str(n) for n in sorted(plain) if n > base]
    out = []
    for name in logs:
        version, *lines = store.read_text(f"{folder}/{name}").split("\n")
        if version != "v1":
            raise ValueError(f"{folder}/{name}: log version {version!r} is not known")
        out += [unquote(e["path"]) for e in map(json.loads, filter(None, lines)) if e["action"] == "add"]
    return out


def stored_rows(spark: SparkSession, files: list[str]) -> int:
    """Rows of these parquet files, from their footers."""
    return spark.read.schema("none long").parquet(*files).count() if files else 0
