"""Write PLANS.md: the physical-plan shape of every registered query.

    python tools/plan_report.py [sf_dir]

For each query: shuffle exchanges, broadcasts, window operators, Expand
(grouping sets / distinct rewrites), sorts, scalar subqueries and the
columns the Parquet scan reads.  Plans are the pre-AQE executed plans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   plan)),
        "single_partition": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "expands": len(re.findall(r"\bExpand \[", plan)),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "subqueries": plan.count("Subquery subquery"),
        "top_k": plan.count("TakeOrderedAndProject"),
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "reused": plan.count("ReusedExchange"),
        "read": sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from allelic.plans.registry import queries
    from allelic.session import get_session
    spark = get_session("local[4]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan shape
    rows = []
    for name, fn in sorted(queries().items()):
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, shape(plan)))
    lines = ["# PLANS — physical-plan shape of every registered query", "",
             "Generated by `tools/plan_report.py` (static plans, AQE off, so no runtime",
             "broadcast conversion is shown). `SinglePartition` exchanges only appear",
             "under global aggregates and global top-k over already-reduced rows.",
             "`scans` counts raw Parquet scans; two scans are column-pruned passes where",
             "one would need a shuffle of the whole input (see tests/test_plans.py).", "",
             "| query | scans | reused exchanges | shuffles | single-partition | broadcasts | windows | expands | sorts | scalar subqueries | top-k | scan reads |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, s in rows:
        read = "; ".join(r.replace(",", ", ") for r in s["read"])
        lines.append(f"| `{name}` | {s['scans']} | {s['reused']} | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | {s['windows']} | "
                     f"{s['expands']} | {s['sorts']} | {s['subqueries']} | {s['top_k']} | {read} |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out} ({len(rows)} queries)")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
