"""The sensor chain: five outputs built once each, failures isolated.

    source -> window features, location profile, pivot, unpivot (of the written
              pivot), date parts -> parquet

Each output is written and read back from storage, so every later step and
every later job starts from files rather than from lineage: a lost executor
costs at most the step it was running. A step whose input failed is skipped.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tidemark.functions.calendar import date_parts
from tidemark.operators.profile import group_profile
from tidemark.operators.reshape import pivot_mean, unpivot_values
from tidemark.operators.series import series_features
from tidemark.sources.io import write_dataset

log = logging.getLogger(__name__)


@dataclass
class Step:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    single_file: bool = False


@dataclass
class ChainReport:
    outputs: dict[str, dict] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.failed and not self.skipped


def run_outputs(steps: Sequence[Step], output_dir: str, inputs: dict[str, DataFrame]) -> ChainReport:
    """Write every step whose needs are there; steps that need it read the written data."""
    report = ChainReport()
    available = dict(inputs)
    for step in steps:
        missing = [n for n in step.needs if n not in available]
        if missing:
            log.warning("no %s without %s", step.name, " and ".join(missing))
            report.skipped.append(step.name)
            continue
        path = f"{output_dir.rstrip('/')}/{step.name}"
        try:
            written = write_dataset(step.build(available), path, step.name, single_file=step.single_file)
        except Exception as exc:  # a step's error is its own: steps that do not need it go on
            log.exception("step %s", step.name)
            report.failed[step.name] = f"{type(exc).__name__}: {exc}"
            continue
        report.outputs[step.name] = written
        available[step.name] = next(iter(inputs.values())).sparkSession.read.parquet(path)
    return report


def sensor_steps(parameters: Sequence[str]) -> list[Step]:
    params = list(parameters)
    return [
        Step("window", lambda d: series_features(d["source"]), ("source",)),
        Step("aggregate", lambda d: group_profile(d["source"], distinct="approx"), ("source",), single_file=True),
        Step("pivot", lambda d: pivot_mean(d["source"], values=params), ("source",)),
        Step("unpivot", lambda d: unpivot_values(d["pivot"], values=params), ("pivot",)),
        Step("date_parts", lambda d: date_parts(d["source"]), ("source",)),
    ]


def sensor_chain(source: DataFrame, output_dir: str, parameters: Sequence[str],
                 persist: bool = False) -> ChainReport:
    """Run the five sensor outputs over ``source``.

    Four outputs read the source. By default each re-reads it: a parquet scan
    prunes columns per output and a generated source is cheaper to recompute
    than to stage, and at scale persisting would copy the whole input onto
    executor disks (the 1M-row chain runs equally fast either way). Pass
    ``persist=True`` for a source that is expensive to recompute.
    """
    if not persist:
        return run_outputs(sensor_steps(parameters), output_dir, {"source": source})
    src = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return run_outputs(sensor_steps(parameters), output_dir, {"source": src})
    finally:
        src.unpersist()


def verify_outputs(spark, output_dir: str, parameters: Sequence[str]) -> DataFrame:
    """The sensor checks (K1-K6, K9) over the written window and aggregate outputs."""
    from tidemark.operators.suite import sensor_suite

    base = output_dir.rstrip("/")
    return sensor_suite(spark.read.parquet(f"{base}/window"), spark.read.parquet(f"{base}/aggregate"), expected_categories=len(parameters))


def main(argv: Sequence[str] | None = None) -> int:
    """Generate readings, write the five outputs, verify them; non-zero exit on any failure."""
    import argparse

    from tidemark.operators.checks import CheckFailed, assert_checks
    from tidemark.session import cores_of, local_session
    from tidemark.sources.synth import PARAMETER_MEANS, synthetic_readings

    ap = argparse.ArgumentParser(prog="python -m tidemark.plans.sensor_chain")
    ap.add_argument("output_dir")
    ap.add_argument("--rows", type=int, default=1_000_000)
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s  %(message)s", datefmt="%H:%M:%S")

    if args.master:
        spark = local_session(cores=cores_of(args.master))
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("tidemark-sensor-chain").getOrCreate()
    params = list(PARAMETER_MEANS)
    report = sensor_chain(synthetic_readings(spark, args.rows), args.output_dir, params)
    for name, out in report.outputs.items():
        log.info("wrote %s: %d rows in %s", name, out["rows"], out["path"])
    if not report.ok:
        log.error("incomplete: %s not built, %s not tried", ", ".join(report.failed) or "none", ", ".join(report.skipped) or "none")
        return 1
    try:
        for row in assert_checks(verify_outputs(spark, args.output_dir, params)):
            log.info("check %s over %d rows: %s", row["check_id"], row["rows_checked"], row["verdict"])
    except CheckFailed as exc:
        log.error("%s", exc)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
