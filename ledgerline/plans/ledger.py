"""A record of a job's completed steps, so that a run that failed can be
taken up where it stopped (C1).

A step is known by (date, name) and the fingerprint of its input; its record
also holds the fingerprint of the files it left. It is skipped only if both
still agree, so new input, or files that were changed or lost meanwhile,
make it run again, and with it what depends on it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.storage import Store

LEDGER_SCHEMA = "date string, step string, input string, output string, result string, runs long"


def rows_fingerprint(df: DataFrame) -> str:
    """Of rows as a bag: their number and two order-free sums of hashes."""
    columns = [F.col(c) for c in df.columns]
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]
    sums = [F.sum(h.cast("decimal(38,0)")) for h in hashes]
    r = df.agg(F.count(F.lit(1)), *sums).first()
    return f"{r[0]}:{r[1]}:{r[2]}"


def files_fingerprint(spark: SparkSession, *folders: str) -> str:
    """Of the data files under folders: names, sizes and times."""
    listed = [Store(spark).files(f) for f in folders]
    return hashlib.sha256(json.dumps(listed).encode()).hexdigest()


class RunLedger:
    def __init__(self, spark: SparkSession, path: str, date: str):
        self.spark, self.store, self.path, self.date = spark, Store(spark), path.rstrip("/"), date
        self.skipped: list[str] = []

    def step(self, name: str, given: str, run: Callable[[], object], left: Callable[[], str] = lambda: "") -> object:
        """The result of ``run()``, from the record if the step was done with
        the input ``given`` and ``left()`` says its files are as it left them.
        Results are kept as JSON."""
        place = f"{self.path}/{self.date}/{name}.json"
        known = json.loads(self.store.read_text(place) or "null")
        if known and known["input"] == given and known["output"] == left():
            self.skipped.append(name)
            return json.loads(known["result"])
        result = run()
        self.store.write_text(place, json.dumps({
            "date": self.date, "step": name, "input": given, "output": left(), "result": json.dumps(result),
            "runs": (known["runs"] if known else 0) + 1}))
        return result


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per (date, step): its last input, output and result, and how
    often it was run."""
    if not Store(spark).exists(path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).json(path)
