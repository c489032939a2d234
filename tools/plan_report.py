"""Summarise the physical plan of every catalogue query as a Markdown table.

usage: python tools/plan_report.py [sf_dir] > PLANS.md-fragment

Each query is executed and the counts are read from AQE's *final* plan: exchanges
that Spark reused for identical subtrees count once (column "reused"), and join
strategies are the ones chosen at run time from measured sizes at this scale factor. Plans
of tables that a query stores on the way are counted with it.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from rateflow import session  # noqa: E402
from rateflow.operators import als, baseline, incremental, layout, recommend  # noqa: E402
from rateflow.plans.catalog import QUERIES  # noqa: E402
from rateflow.session import build_session  # noqa: E402

# Modules that store tables on the way; those plans count as the query's.
STORING = [als, baseline, incremental, layout, recommend]

COUNTS = [
    ("shuffles", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("partial aggs", r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_|SortAggregate\(key=\[[^\]]*\], functions=\[partial_"),
    ("sort aggs", r"SortAggregate"),
    ("top-K limits", r"WindowGroupLimit"),
    ("windows", r"\bWindow \["),
    ("reused", r"ReusedExchange"),
]


def final_part(plan: str) -> str:
    """The plan without its initial parts, those of subqueries included: lines under an
    "Initial Plan" heading go, up to the next line that is indented no deeper."""
    kept, skip = [], None
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = line.index("==") - 1
            continue
        kept.append(line)
    return "\n".join(kept)


def executed_plan(df) -> str:
    """Run the query and return its final plan."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    return final_part(executed.toString())


def recorded(plans: list[str]):
    """``materialize`` that also keeps the plan of what it stores."""
    def store(df, name):
        plans.append(executed_plan(df))
        return session.materialize(df, name)
    return store


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    print(f"| query | {' | '.join(c for c, _ in COUNTS)} | shipdate pushed | scans |")
    print("| --- |" + " --- |" * (len(COUNTS) + 2))
    for name, fn in QUERIES.items():
        stored: list[str] = []
        for module in STORING:
            module.materialize = recorded(stored)
        plan = "\n".join([executed_plan(fn(spark, sf_dir)), *stored])
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
        cells = [str(len(re.findall(rx, plan))) for _, rx in COUNTS]
        pushed = "yes" if re.search(r"PushedFilters: \[[^\n]*?(LessThan|GreaterThanOrEqual)\(l_shipdate", plan) else "-"
        scans = len(re.findall(r"FileScan (parquet|text)", plan))
        print(f"| {name} | {' | '.join(cells)} | {pushed} | {scans} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
