"""Benchmark of the headline marts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs every headline query once to warm the JVM, then ``BENCH_RUNS`` times
(default 3) and reports the median, least and greatest. Each query is executed in
full through the ``noop`` sink. The ingest of the derived fixture ledger is a
line of its own, and the reference-shaped seven-join plan of the payments mart
is timed beside the one-pass plan on the same cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

ROOT = Path(__file__).resolve().parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from naive import naive_payments_mart  # noqa: E402

from ledgerloom.queries import QUERIES, _t  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

HEADLINE = [
    "mart_payments",
    "mart_payments_sql",
    "mart_payments_v1",
    "sql_text_payments",
    "mart_account",
    "mart_account_sql",
    "mart_info",
    "mart_info_sql",
    "kernel",
    "ops_converted",
]
COMPARED = {"naive_payments": lambda spark, sf_dir: naive_payments_mart(_t(spark, sf_dir), "frame")}


def run(spark, query, sf_dir: str) -> float:
    t0 = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus, driver_memory="16g",
                          app="ledgerloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.perf_counter()
    _t(spark, sf_dir)
    ingest = time.perf_counter() - t0
    queries = {n: QUERIES[n] for n in names} | COMPARED
    for q in queries.values():
        run(spark, q, sf_dir)
    times: dict[str, list[float]] = {n: [] for n in queries}
    for _ in range(runs):  # in rounds, so that a slow spell of the machine meets every query
        for n, q in queries.items():
            times[n].append(run(spark, q, sf_dir))
    mid = {n: round(median(t), 3) for n, t in times.items()}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_marts_total",
        "value": round(sum(mid[n] for n in names), 3),
        "unit": "sec",
        "queries": mid,
        "spread": {n: [round(min(t), 3), round(max(t), 3)] for n, t in times.items()},
        "ingest_first_sec": round(ingest, 3),
        "runs": runs,
        "cpus": cpus,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
