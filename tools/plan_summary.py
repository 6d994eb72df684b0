"""Summarise the physical plans of the headline queries (writes PLANS.md).

    python tools/plan_summary.py [sf_dir] > PLANS.md

For each query: shuffles (with their keys), broadcasts, joins, aggregates,
and every scan's pruned read schema, pushed filters and partition filters,
taken from ``explain("formatted")``.
"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.queries import QUERIES  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

HEADLINE = ["mart_payments", "mart_payments_sql", "mart_payments_v1", "mart_account", "mart_info",
            "kernel", "ops_converted", "src_partitioned"]


def summary(plan: str) -> list[str]:
    out = []
    shuffles = re.findall(r"Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)"
                          r"|RoundRobinPartitioning\([^)]*\)|SinglePartition)[^\n]*", plan)
    keys = [re.sub(r"#\d+L?", "", s) for s in shuffles]
    out.append(f"- shuffles: {len(keys)}")
    out += [f"  - `{k}`" for k in keys]
    for name in ("BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                 "BroadcastNestedLoopJoin", "HashAggregate", "Generate", "Window"):
        n = len(re.findall(rf"^\(\d+\) {name}\b", plan, re.M))
        if n:
            out.append(f"- {name}: {n}")
    for m in re.finditer(r"^\(\d+\) Scan (\w+)[^\n]*\n(.*?)(?=\n\(\d+\)|\Z)", plan, re.M | re.S):
        body = m.group(2)
        rs = re.search(r"ReadSchema: (.*)", body)
        pf = re.search(r"PushedFilters: (.*)", body)
        pt = re.search(r"PartitionFilters: (.*)", body)
        if rs:
            line = f"- scan {m.group(1)}: `{rs.group(1)}`"
            if pf and pf.group(1) != "[]":
                line += f"; pushed `{pf.group(1)}`"
            if pt and pt.group(1) != "[]":
                line += f"; partition filters `{re.sub(r'#[0-9]+', '', pt.group(1))}`"
            out.append(line)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (local[8], AQE on; the final")
    print("adaptive plan may convert further joins to broadcasts at run time).\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        print(f"## {name}\n")
        print("\n".join(summary(buf.getvalue())))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
