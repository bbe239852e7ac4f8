"""Bytes read and shuffled per query, from Spark's event log.

    python tools/shuffle_report.py [--sf-dir DIR] [name ...]

Runs each query once into the no-op sink with the event log written to a fresh
scratch folder, then sums task metrics per query (its jobs carry the query
name as job group): input rows read from files, shuffle rows and bytes written, and
the largest single task's shuffle read. Rows and bytes shuffled per input row
are what carry over to larger inputs (parquet input bytes are not reported
by the local file system, rows are).
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

DEFAULT = ["location_profile", "series_features", "pivot_mean", "unpivot_values", "date_parts",
           "ticker_metrics", "bars_clean", "upsert_report", "upsert_report_small_batch", "sensor_checks",
           "search_ids", "readings_page"]


def _lines(path: str):
    """Lines of one event file; Spark 4 writes zstd-compressed rolling logs."""
    with open(path, "rb") as fh:
        data = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        data = zstandard.ZstdDecompressor().stream_reader(data).read()
    return data.decode("utf-8").splitlines()


def parse(log_dir: str) -> dict[str, dict[str, float]]:
    stage_group: dict[int, str] = {}
    totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        for line in _lines(path):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    t = totals[group]
                    t["input_rows"] += m.get("Input Metrics", {}).get("Records Read", 0)
                    w = m.get("Shuffle Write Metrics", {})
                    t["shuffle_write_bytes"] += w.get("Shuffle Bytes Written", 0)
                    t["shuffle_write_rows"] += w.get("Shuffle Records Written", 0)
                    r = m.get("Shuffle Read Metrics", {})
                    read = r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
                    t["max_task_shuffle_read"] = max(t["max_task_shuffle_read"], read)
                    t["tasks"] += 1
    return totals


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    spark = local_session(app="tidemark-shuffle-report",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    queries, _ = catalog.load_all()
    names = args.names or DEFAULT
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        queries[name](spark, args.sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    totals = parse(log_dir)
    print(f"{'query':28s} {'input rows':>11s} {'shuffled rows':>14s} {'rows/input':>10s} "
          f"{'bytes/input row':>15s} {'max task read KB':>17s}")
    for name in names:
        t = totals.get(name, {})
        rows, srows, sbytes = t.get("input_rows", 0.0), t.get("shuffle_write_rows", 0.0), t.get("shuffle_write_bytes", 0.0)
        per = (srows / rows, sbytes / rows) if rows else (float("nan"), float("nan"))
        print(f"{name:28s} {rows:11.0f} {srows:14.0f} {per[0]:10.2f} {per[1]:15.1f} "
              f"{t.get('max_task_shuffle_read', 0) / 1e3:17.1f}")


if __name__ == "__main__":
    main()
