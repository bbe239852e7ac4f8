"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through Spark's no-op sink (every row is
produced, nothing is collected) three times in a row at the target scale: the
first (cold: class loading, code generation, JIT) is reported under ``cold``,
the better of the other two (warm; this VM's timings vary a lot between runs)
under ``queries`` and in ``value``. ``chain_1m_five_outputs`` is
the surveyed application's own workload: one million synthetic readings
quotes at about 15 s; it is timed the same way, and so are the checks and the
distinct ids over its written output.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.operators.serve import distinct_ids  # noqa: E402
from tidemark.plans.sensor_chain import sensor_chain, verify_outputs  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import synth  # noqa: E402

HEADLINE = (
    "location_profile",
    "series_features",
    "pivot_mean",
    "unpivot_values",
    "date_parts",
    "sensor_checks",
    "bars_clean",
    "bars_repair_report",
    "ticker_metrics",
    "return_distribution",
    "upsert_report",
    "fingerprint",
    "sensor_parameter_summaries",
    "readings_page",
    "search_ids",
)
CHAIN_ROWS = 1_000_000


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="tidemark-bench")
    queries, _ = catalog.load_all()

    cold: dict[str, float] = {}
    times: dict[str, float] = {}
    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        runs = [timed(lambda: run(queries[name](spark, sf_dir))) for _ in range(3)]
        cold[name], times[name] = runs[0], min(runs[1:])

    params = list(synth.PARAMETER_MEANS)
    reports, folders = [], []

    def chain() -> None:
        folders.append(tempfile.mkdtemp(prefix="tidemark-bench-"))
        reports.append(sensor_chain(synth.synthetic_readings(spark, CHAIN_ROWS), folders[-1], params))

    extra = {
        "chain_1m_five_outputs": chain,
        # The application's own checks and its distinct ids, over the written million rows.
        "chain_1m_checks": lambda: run(verify_outputs(spark, folders[-1], params)),
        "chain_1m_distinct_ids": lambda: run(distinct_ids(spark.read.parquet(f"{folders[-1]}/window"))),
    }
    for name, fn in extra.items():
        runs = [timed(fn) for _ in range(3)]
        cold[name], times[name] = runs[0], min(runs[1:])
    report = reports[-1]
    if not all(r.ok for r in reports):
        raise SystemExit(f"chain failed: {report.failed} skipped {report.skipped}")

    total = round(sum(v for k, v in times.items() if k in HEADLINE), 3)
    print(json.dumps({
        "metric": "headline_queries_total_warm",
        "value": total,
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "chain_rows": {k: v["rows"] for k, v in report.outputs.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
