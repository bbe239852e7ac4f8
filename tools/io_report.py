"""Rows read and written by partial loads, lookups, deep pages and indexed searches, from Spark's event log.

    python tools/io_report.py [--rows N]

Generates readings and bars of N rows, runs each request as a job group of its
own with the event log in a scratch folder, and prints one JSON line: per
request the rows its tasks read from files and wrote, beside the table's rows.
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

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import layouts  # noqa: E402
from tidemark.operators.versions import VersionedTable  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tools.shuffle_report import _lines  # noqa: E402

TICKERS, SENSORS = 50, 5_000
BARS = "date date, ticker string, close double"


def tally(log_dir: str) -> dict[str, dict[str, int]]:
    """Rows read and rows and bytes written per job group."""
    group_of: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)):
        for line in _lines(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event.get("Stage IDs", []):
                    group_of[stage] = (event.get("Properties") or {}).get("spark.jobGroup.id")
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics, total = event.get("Task Metrics") or {}, totals[group_of.get(event["Stage ID"])]
                total["read"] += metrics.get("Input Metrics", {}).get("Records Read", 0)
                total["written"] += metrics.get("Output Metrics", {}).get("Records Written", 0)
                total["bytes_written"] += metrics.get("Output Metrics", {}).get("Bytes Written", 0)
    return totals


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--rows", type=int, default=200_000)
    rows = ap.parse_args().rows
    scratch = tempfile.mkdtemp(prefix="tidemark-io-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = local_session(cores=4, shuffle_partitions=8, app="tidemark-io-report",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})

    def group(name: str) -> None:
        spark.sparkContext.setJobGroup(name, name)

    n = F.col("id")
    bars = spark.range(rows).select(
        F.date_add(F.lit("1900-01-01").cast("date"), F.floor(n / TICKERS).cast("int")).alias("date"),
        F.format_string("T%02d", n % TICKERS).alias("ticker"), (n % 977).cast("double").alias("close"))
    table = VersionedTable(spark, f"{scratch}/bars", BARS, "ticker", "date")
    group("load_all")
    table.load(bars, ["date", "ticker"], ["close"])
    group("load_one_ticker")
    table.load(bars.where("ticker = 'T07'").withColumn("close", F.col("close") + 1), ["date", "ticker"], ["close"])
    group("load_nothing_new")
    table.load(bars.where("ticker = 'T08'"), ["date", "ticker"], ["close"])

    readings = spark.range(rows).select(
        F.format_string("%07d", F.pmod(F.xxhash64("id"), F.lit(SENSORS))).alias("sensor_id"),
        F.lit("p").alias("parameter"), n.alias("seq"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)).cast("double").alias("value"))
    group("layouts")
    # Small row groups, so that a small table has many.
    layouts.write_clustered(readings, f"{scratch}/clustered", ["sensor_id", "seq"], row_group_bytes=64 << 10, ranges=8)
    ranked = layouts.RankedTable(spark, f"{scratch}/ranked")
    ranked.write(readings, [F.col("value").desc(), F.col("seq").asc()], 64)
    grams = layouts.GramIndex(spark, f"{scratch}/grams")
    grams.write(readings)
    pairs = spark.read.parquet(f"{scratch}/grams/grams").count()
    group("lookup")
    found = layouts.lookup(spark, f"{scratch}/clustered", "0001234").count()
    group("deep_page")
    page = ranked.page(9 * rows // 10, 50).collect()
    group("search")
    hits = grams.search("0123").collect()
    spark.stop()
    told = {k: dict(v) for k, v in tally(log_dir).items() if k and k != "layouts"}
    print(json.dumps({"rows": rows, "gram_rows": pairs, "found": found, "page": len(page), "hits": len(hits), **told}))


if __name__ == "__main__":
    main()
