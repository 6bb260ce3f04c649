"""Summarize the physical plan of every registered query (static plan, before AQE).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts shuffles (Exchange), broadcasts and join strategies, and lists the filters
pushed into each scan. Keys that write (sources, sinks, stream) are planned after
their writes, i.e. the plan shown is the read of what they produced.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\s+(?:\[[^\]]*\], \[[^\]]*\], )?(\w+)", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted({f"{j} {t}" for j, t in joins}),
        "partial_agg": "partial_" in plan,
        "top_k": "TakeOrderedAndProject" in plan,
        "pushed": sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan) if p.strip()}),
        "partition_filters": sorted({p for p in re.findall(r"PartitionFilters: \[([^\]]+)\]", plan) if p.strip()}),
    }


def main() -> None:
    from lakeweave.registry import raw_queries
    from lakeweave.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=32)
    print(f"# Physical plans of the registered queries ({os.path.basename(sf)}, static plans)\n")
    print("| key | shuffles | broadcasts | joins | partial agg | top-k | pushed filters / partition filters |")
    print("|---|---|---|---|---|---|---|")
    for k, fn in sorted(raw_queries().items()):
        df = fn(spark, sf)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        filt = "; ".join(s["pushed"][:3] + [f"partition: {p}" for p in s["partition_filters"]])
        print(
            f"| `{k}` | {s['shuffles']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
            f"{'yes' if s['partial_agg'] else '-'} | {'yes' if s['top_k'] else '-'} | {filt or '-'} |"
        )


if __name__ == "__main__":
    main()
