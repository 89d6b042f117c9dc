"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is timed end to end (plan + execute) with a full pass over its
result via a no-op sink, so nothing is collected to the driver. The best of
``BENCH_REPEAT`` runs is reported per query; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.queries import HEADLINE, QUERIES, WRITERS  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up: JVM, codegen caches, file listing
    QUERIES["scan_day"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
    # Queries that write many files: one run each, not part of the total.
    writers = {}
    for name in [] if "BENCH_QUERIES" in os.environ else WRITERS:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        writers[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "writers": writers,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
