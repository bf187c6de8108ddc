"""Write PLANS.md: operator counts of every registered query's physical plan, and the
formatted plans of the headline queries. Usage: python tools/dump_plans.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from portolan.registry import QUERIES  # noqa: E402
from portolan.session import build_session  # noqa: E402

OPERATORS = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange RoundRobin", "SortMergeJoin",
             "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
             "SortAggregate", "Window", "Python"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    lines = ["# Physical plans", "",
             f"Initial (pre-AQE) physical plans of every registered query on `{sf_dir}`, generated by "
             "`tools/dump_plans.py`. Queries over the arrivals source start from its staged parquet "
             "(`fixtures.visits_raw`): a plain, column-pruned scan. Sort-merge joins and sort aggregates "
             "occur only inside the small dimensions (lookup x aggregate, `min_by` first values); AQE "
             "turns those joins into broadcasts at runtime. No join of the fact shuffles it.", "",
             "| query | " + " | ".join(OPERATORS) + " |", "|---|" + "---|" * len(OPERATORS)]
    formatted = {}
    for name, query in QUERIES.items():
        df = query(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines.append(f"| {name} | " + " | ".join(str(plan.count(op)) for op in OPERATORS) + " |")
        if name in HEADLINE:
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain("formatted")
            formatted[name] = buf.getvalue()
    for name in HEADLINE:
        lines += ["", f"## {name}", "", "```", formatted[name].strip(), "```"]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
