"""How much of a hot series one task has to hold, plain windows vs the blocked route.

    python tools/skew_report.py [--rows 1000000]

Builds synthetic readings where one series holds about a third of all rows
(chosen by a hash draw), runs ``series_features`` twice - once forced onto
plain per-series windows, once routed with a small ``hot_rows`` so the hot
series takes the blocked path - and reads from the event log the most records
any single task fetched in a shuffle (64 shuffle partitions, AQE off, so an
even share is rows/64). Both runs must produce the same rows.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.draws import uniform  # noqa: E402
from tidemark.operators.series import series_features  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources.synth import synthetic_readings  # noqa: E402
from tools.shuffle_report import _lines  # noqa: E402


def max_task_records(log_dir: str) -> dict[str, int]:
    stage_group: dict[int, str] = {}
    worst: dict[str, int] = defaultdict(int)
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        for line in _lines(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    if group:
                        stage_group[sid] = group
            elif ev.get("Event") == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"))
                read = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
                if group:
                    worst[group] = max(worst[group], read.get("Total Records Read", 0))
    return worst


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--rows", type=int, default=1_000_000)
    ap.add_argument("--hot-rows", type=int, default=50_000)
    ap.add_argument("--block-rows", type=int, default=20_000)
    ap.add_argument("--seq-order", choices=("time", "random"), default="time",
                    help="time: seq follows the date, like event ids; random: seq unrelated to the date")
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="tidemark-skew-")
    # Many shuffle partitions and no coalescing: an evenly spread task then
    # reads about rows/64 records, so whatever one task reads above that is skew.
    spark = local_session(app="tidemark-skew-report", shuffle_partitions=64,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.sql.adaptive.enabled": "false"})
    base = synthetic_readings(spark, args.rows)
    hot = uniform(F.col("seq"), 7) < 1 / 3
    # time: readings arrive in date order (the day advances with seq, as with
    # event ids); random: the day is a hash draw unrelated to seq.
    day = (F.date_add(F.lit("2025-01-01").cast("date"), (F.col("seq") * 365 / args.rows).cast("int"))
           if args.seq_order == "time" else F.col("reading_date"))
    skewed = base.select(
        F.when(hot, F.lit("hotspot")).otherwise(F.col("sensor_id")).alias("sensor_id"), day.alias("reading_date"),
        F.when(hot, F.lit("Hungary")).otherwise(F.col("location")).alias("location"),
        F.when(hot, F.lit("Noise")).otherwise(F.col("parameter")).alias("parameter"),
        "value", "status", "seq",
    )
    out = tempfile.mkdtemp(prefix="tidemark-skew-out-")
    runs = {
        "plain windows": dict(hot_rows=args.rows * 10),
        "routed (hot series blocked)": dict(hot_rows=args.hot_rows, block_rows=args.block_rows),
    }
    secs = {}
    for name, kw in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        series_features(skewed, **kw).write.mode("overwrite").parquet(f"{out}/{len(secs)}")
        secs[name] = time.perf_counter() - t0
    a, b = (spark.read.parquet(f"{out}/{i}") for i in range(2))
    equal = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot_count = skewed.where("sensor_id = 'hotspot'").count()
    spark.stop()
    worst = max_task_records(log_dir)
    print(f"rows={args.rows:,} seq order={args.seq_order} hot series rows={hot_count:,} identical results={equal}")
    for name in runs:
        print(f"{name:30s} max records read by one task: {worst.get(name, 0):>10,}   {secs[name]:.1f}s")


if __name__ == "__main__":
    main()
