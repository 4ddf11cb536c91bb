"""Print the operators of the physical plans of selected registered queries
(scans with their read schema and pushed filters, exchanges, joins, window
limits, Arrow batch functions) — the checklist used when reviewing a plan.

usage: python tools/plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.session import get_session  # noqa: E402

KEEP = re.compile(r"^\s*[:+\-| ]*(Scan|Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|"
                  r"ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|Window|WindowGroupLimit|"
                  r"MapInArrow|MapInPandas|ArrowEvalPython|Generate|HashAggregate|ObjectHashAggregate|"
                  r"SortAggregate|AdaptiveSparkPlan)")


def outline(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln.rstrip() for ln in plan.splitlines() if KEEP.match(ln)]
    schema = [m[:300] for m in re.findall(r"(ReadSchema: struct<[^>]*>|PushedFilters: \[.*?\], ReadSchema)",
                                    df._jdf.queryExecution().executedPlan().toString())]
    return lines + schema


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or ["knn_flat", "search_rerank"]
    spark = get_session("local[8]", shuffle_partitions=8)
    for name in names:
        print(f"== {name}")
        for ln in outline(QUERIES[name](spark, sf_dir)):
            print("  " + ln)


if __name__ == "__main__":
    main()
