"""Print the physical plan shape of every catalog query.

usage: python tools/explain_plans.py [sf_dir] [key ...] [--full]

One line per query: shuffles (Exchange), broadcasts, partial aggregates,
whole-stage-codegen stages, and whether a Python UDF node appears. ``--full``
also prints ``explain("formatted")``. Landing queries are planned on their
read-back table (their write already ran).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanflow.plans.catalog import QUERIES  # noqa: E402
from urbanflow.session import build_session  # noqa: E402

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def shape(plan: str) -> dict[str, object]:
    return {
        "shuffles": len(re.findall(r"Exchange (hash|range|round|Single)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "partial_aggs": len(re.findall(r"partial_", plan)) > 0,
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
        "python": any(n in plan for n in PY_NODES),
    }


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--full"]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = build_session("explain", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for k in keys:
        df = QUERIES[k](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"{k:24s} {shape(plan)}")
        if "--full" in sys.argv:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
