"""Write PLANS.md: the physical operators of every registered query.

Planned "as at scale": broadcast-by-size off and AQE off, so every join and
aggregate shows the exchange it needs on large inputs (at run time AQE may
still choose a broadcast from measured sizes).  Usage:
``python tools/plan_report.py [sf_dir] > PLANS.md``
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ("Exchange hashpartitioning", "Exchange RoundRobinPartitioning", "Exchange rangepartitioning",
       "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "WindowGroupLimit", "Window [", "Expand", "Generate", "FileScan parquet", "Scan json",
       "InMemoryTableScan")


def summary(plan: str) -> str:
    c = Counter()
    for op in OPS:
        c[op.rstrip(" [")] = plan.count(op)
    partial = len(re.findall(r"WindowGroupLimit[^\n]*Partial", plan))
    parts = [f"{k} {v}" for k, v in c.items() if v]
    if partial:
        parts.append(f"(partial group limits {partial})")
    return ", ".join(parts)


def main(argv):
    from matchlake.plans import QUERIES
    from matchlake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                             "spark.sql.adaptive.enabled": "false"})
    print("# PLANS\n")
    print("Physical operators per registered query, planned as on large inputs "
          "(no size-based broadcast, no AQE re-plan; generated by `tools/plan_report.py`).\n")
    print("| query | operators |\n| --- | --- |")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| {name} | {summary(plan)} |")


if __name__ == "__main__":
    main(sys.argv)
