"""Physical-plan shape of registered queries: exchanges, broadcasts, windows, scans.

    python tools/plan_report.py [--sf-dir DIR] [name ...]

Counts operators in the executed plan string (AQE off, so the static plan is
shown) and lists what each parquet scan reads and pushes down.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

COUNTED = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "window": r"\bWindow ",
    "sort_agg": r"SortAggregate",
    "hash_agg": r"HashAggregate|ObjectHashAggregate",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def shape(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {k: len(re.findall(v, plan)) for k, v in COUNTED.items()}
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    out["scans"] = [(cols.count(",") + 1, pushed) for cols, pushed in scans]
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    queries, _ = catalog.load_all()
    for name in args.names or sorted(queries):
        s = shape(queries[name](spark, args.sf_dir))
        counts = " ".join(f"{k}={v}" for k, v in s.items() if k != "scans" and v)
        pushed = "; ".join(f"{n} cols [{p}]" if p else f"{n} cols" for n, p in s["scans"])
        print(f"{name:34s} {counts}\n{'':34s} scans: {pushed}")


if __name__ == "__main__":
    main()
