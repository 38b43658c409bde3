"""Tabulate the executed (AQE final) physical plan of every registered query.

    python tools/plan_report.py [sf_dir [name to leave out ...]] > PLANS.md

Each query is run once, then its final plan is scanned
for the operators that decide cost at scale: shuffles by kind, join
strategies, windows, and Python evaluation. Counts include all stages of the
final plan (broadcast builds and reused exchanges are listed separately).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = [
    ("hash x", r"Exchange hashpartitioning"),
    ("range x", r"Exchange rangepartitioning"),
    ("single x", r"Exchange SinglePartition"),
    ("rebalance x", r"Exchange RoundRobinPartitioning|REBALANCE"),
    ("bcast", r"BroadcastExchange"),
    ("reused", r"ReusedExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("SHJ", r"ShuffledHashJoin"),
    ("BNLJ", r"BroadcastNestedLoopJoin"),
    ("window", r"\bWindow \["),
    ("python", r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn|FlatMapCoGroupsIn"),
]


def final_plan(df) -> str:
    """The final-plan section of an executed adaptive plan (its text also holds the initial plan)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from aerolith.plans.registry import load_all
    from aerolith.session import build_session
    spark = build_session(master="local[8]", shuffle_partitions=8, app_name="aerolith-plans")
    reg = load_all()
    print(f"# Executed plans of the registered queries ({os.path.basename(sf_dir)}, AQE final plans)\n")
    print("Generated by `tools/plan_report.py`. `x` = shuffle exchange. A query that writes an intermediate "
          "table (layers, segments, histograms, query tables) shows only the plan that reads it back.\n")
    print("| query | " + " | ".join(c for c, _ in COLUMNS) + " |")
    print("|---|" + "---|" * len(COLUMNS))
    skip = set(sys.argv[2:])
    for name, (fn, _) in reg.items():
        if name in skip:
            continue
        try:
            df = fn(spark, sf_dir)
            df.collect()  # small at the check scale; runs this DataFrame's own adaptive plan to its end
            plan = final_plan(df)
            cells = [str(len(re.findall(rx, plan))) for _, rx in COLUMNS]
        except Exception as e:  # noqa: BLE001 - report and continue
            cells = [f"error: {type(e).__name__}"] + [""] * (len(COLUMNS) - 1)
        print(f"| `{name}` | " + " | ".join(c if c != "0" else "" for c in cells) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
