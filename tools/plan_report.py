"""Summarise the physical plans of catalog queries (after execution, AQE final).

Usage: python tools/plan_report.py SF_DIR key [key ...]
Prints, per query: exchange count, join strategies, window group limits and
the Parquet scans with their read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> str:
    # run this very query execution (rows counted in the executors, none
    # collected) so its adaptive plan is final, then print that plan
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    plan = qe.executedPlan().toString()
    assert "isFinalPlan=true" in plan
    plan = plan.split("Initial Plan")[0]          # the final section only
    ops = Counter()
    for name in ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
                 "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "ShuffledHashJoin",
                 "BroadcastHashJoin", "WindowGroupLimit", "HashAggregate", "Window "):
        ops[name] = plan.count(name)
    scans = sorted(set(re.findall(r"FileScan parquet \[[^\]]*\].*?ReadSchema: (struct<[^>]*>)", plan)))
    out = [f"  {k}: {v}" for k, v in ops.items() if v]
    out += [f"  scan {s}" for s in scans[:12]]
    return "\n".join(out)


def main():
    from tastebud.plans import catalog
    from tastebud.session import build_session
    sf = sys.argv[1]
    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for k in sys.argv[2:]:
        print(f"## {k}")
        print(summarise(catalog.QUERIES[k](spark, sf)))


if __name__ == "__main__":
    main()
