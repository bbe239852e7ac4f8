"""The bars chain: raw bars -> repair (with a drop report) -> validation -> keyed
load into a new snapshot -> metrics.

    python -m tidemark.plans.bars_chain RAW_PATH SNAPSHOT_BASE [--tickers A,B] [--master local[4]]

Snapshots live in ``SNAPSHOT_BASE/v=<n>``; a run reads the newest one, writes
``v=<n+1>`` and never overwrites what it reads, so earlier versions stay as
history; a folder without ``_SUCCESS`` is a run that died and is never read.
Running the same raw data twice inserts and updates nothing.  The whole drop
report of a run is a table of its own in ``SNAPSHOT_BASE/drops``.

With ``--incremental`` the base holds versioned tables (:mod:`tidemark.operators.versions`)
and a manifest: only tickers whose raw bars or request differ from what the
manifest records are repaired, loaded and measured again.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bars, checks, merge, versions
from tidemark.operators.versions import VersionedTable
from tidemark.sources import io

log = logging.getLogger(__name__)

KEY = ["date", "ticker"]
VALUES = ["open", "high", "low", "close", "volume", "dividends", "stock_splits"]


# First lines of the repair report that a run logs and returns; the report itself is a table.
REPORTED = 10_000
# Folder of the reports under the snapshot base, one table a run.
REPORTS = "drops"


class ValidationFailed(ValueError):
    pass


@dataclass
class BarsRun:
    snapshot: str
    version: int
    dropped: list
    load: dict
    report: str
    report_lines: int


@dataclass
class BarsRebuild:
    """What an incremental run did; ``load`` is None when nothing had to be done."""

    built: list
    dropped: list
    kept: int
    clean_version: int | None
    metrics_version: int | None
    manifest_version: int | None
    load: dict | None


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Newest completely written ``v=<n>`` under ``base``; None when there is none."""
    done = [n for n, whole in merge.snapshot_versions(spark, base).items() if whole]
    return max(done, default=None)


#: The ``ohlcv`` table, and the metrics of each of its bars.
OHLCV = "date date, ticker string, open double, high double, low double, close double, volume bigint, dividends double, stock_splits double"
METRICS = (
    "date date, ticker string, open double, high double, low double, close double, volume bigint, "
    "indexed_close double, daily_return_pct double, drawdown_pct double, volatility_30d_pct double"
)


def empty_snapshot(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OHLCV)


def require_arrival(normal: DataFrame, arrival: str) -> None:
    """Raise when a ticker's dates do not arrive in order."""
    late = checks.out_of_order(normal, "ticker", "date", arrival).where("late > 0")
    first = late.orderBy("ticker").limit(merge.SHOWN).collect()
    if first:
        raise ValidationFailed("dates out of order: " + "; ".join(f"{r['ticker']}: {r['late']} row(s)" for r in first))


def require_no_ties(annotated: DataFrame) -> None:
    """Raise when different bars of one day share the largest ``seq``: which one is right is not in the data."""
    tied = bars.ties_from(annotated, "_tied").orderBy("ticker").limit(merge.SHOWN).collect()
    if tied:
        raise ValidationFailed("several last bars: " + "; ".join(f"{r['ticker']}: {r['ties']} day(s)" for r in tied))


def require_valid(clean: DataFrame, wanted: DataFrame) -> None:
    """Raise when a wanted ticker has no bars left, or bars that are not fit to load."""
    failing = checks.validate_bars(clean, wanted).where(F.col("failures") > 0).orderBy("ticker").limit(merge.SHOWN).collect()
    if failing:
        detail = "; ".join(f"{r['ticker']}: {r['failures']} failure(s), {r['rows']} rows" for r in failing)
        raise ValidationFailed(f"bars not fit to load: {detail}")


def bars_chain(spark: SparkSession, raw: DataFrame, snapshot_base: str, wanted: Sequence[str] | None = None,
               arrival: str | None = None) -> BarsRun:
    """Run the chain once over ``raw`` (the raw bars with ``seq``, ``ts`` and ``exchange_tz``).

    ``arrival`` names a unique arrival number of the raw rows; with it, a run
    whose dates do not arrive in order stops before anything is written, as
    does one in which different bars of a day share the largest ``seq``.
    """
    normal = bars.normalize(raw)
    if arrival is not None:
        require_arrival(normal, arrival)
        normal = normal.drop(arrival)
    annotated = bars.annotate_repairs(normal, tie_as="_tied")
    require_no_ties(annotated)
    annotated = annotated.drop("_tied")
    written = io.write_dataset(bars.report_from(annotated), f"{snapshot_base}/{REPORTS}/{uuid.uuid4().hex}", mode="error")
    dropped = spark.read.parquet(written["path"]).orderBy("ticker", "rule").limit(REPORTED).collect()
    for row in dropped:
        log.warning("repairs of %s removed %d row(s) by rule %s", row["ticker"], row["dropped"], row["rule"])
    log.info("repair report: %d line(s), the first %d logged -> %s", written["rows"], len(dropped), written["path"])
    clean = bars.conform(bars.clean_from(annotated), bars.OHLCV_COLUMNS, {"volume": "long"})

    wanted_df = (spark.createDataFrame([(t,) for t in wanted], "ticker string") if wanted is not None
                 else raw.select("ticker").distinct())
    require_valid(clean, wanted_df)

    taken = merge.snapshot_versions(spark, snapshot_base)
    current = latest_version(spark, snapshot_base)
    target = empty_snapshot(spark) if current is None else spark.read.parquet(f"{snapshot_base}/v={current}")
    snapshot, report = merge.upsert(target, clean, KEY, VALUES)
    # Past every folder there is, so that a run which died does not block its number.
    version = max(taken, default=-1) + 1
    path = merge.write_snapshot(snapshot, snapshot_base, version)
    load = report.get
    log.info("snapshot %d holds %d rows: %d new, %d replaced", version, load["total"], load["inserted"], load["updated"])
    return BarsRun(path, version, [r.asDict() for r in dropped], load, written["path"], written["rows"])


def tables_of(spark: SparkSession, base: str) -> tuple[VersionedTable, VersionedTable, VersionedTable]:
    """The versioned tables of an incremental base: repaired bars, loaded bars, metrics."""
    return tuple(VersionedTable(spark, f"{base}/{name}", columns, "ticker", "date")
                 for name, columns in (("clean", OHLCV), ("bars", OHLCV), ("metrics", METRICS)))


def bars_rebuild(spark: SparkSession, raw: DataFrame, base: str, request: str, wanted: Sequence[str] | None = None,
                 arrival: str | None = None, force: bool = False) -> BarsRebuild:
    """Bring the tables under ``base`` up to ``raw``, redoing only what differs from the manifest.

    The manifest records, per ticker, the fingerprint of the raw bars and the
    ``request`` they answer (period and interval of the download). Tickers that
    are new, differ or were asked for otherwise are repaired, validated and
    replace their part of the ``clean`` table; tickers that are gone leave it.
    The ``bars`` table takes the rebuilt tickers by keyed load, which writes
    only tickers in which a bar is new or differs and never deletes one; their
    metrics replace the old ones. The manifest is written last: a run that dies
    or fails validation leaves the record as it was, and the next one starts
    over. With nothing to do, nothing is written.
    """
    normal = bars.normalize(raw)
    inputs = normal.drop(arrival) if arrival is not None else normal
    recorded_base = f"{base}/manifest"
    now = versions.manifest_of(inputs, "ticker", request)
    recorded = versions.read_manifest(spark, recorded_base, now)
    if wanted is not None:
        merge.require_inputs(spark.createDataFrame([(t,) for t in wanted], "input string"), inputs.select(F.col("ticker").alias("input")))
    now = now.persist()  # one line per ticker: compared here, recorded at the end
    try:
        plan = versions.rebuild_plan(now, recorded, "ticker", force).select("ticker", "action").collect()
        built = sorted((r["ticker"] for r in plan if r["action"] == versions.BUILD), key=str)
        gone = sorted((r["ticker"] for r in plan if r["action"] == versions.DROP), key=str)
        kept = len(plan) - len(built) - len(gone)
        clean_table, bars_table, metrics_table = tables_of(spark, base)
        if not built and not gone:
            log.info("rebuild: %d ticker(s) as recorded, nothing to do", kept)
            return BarsRebuild([], [], kept, clean_table.version(), metrics_table.version(), None, None)

        named = spark.createDataFrame([(t,) for t in built], "ticker string")
        todo = versions.only_groups(normal, named, "ticker")
        if arrival is not None:
            require_arrival(todo, arrival)
            todo = todo.drop(arrival)
        annotated = bars.annotate_repairs(todo, tie_as="_tied")
        require_no_ties(annotated)
        clean = bars.conform(bars.clean_from(annotated), bars.OHLCV_COLUMNS, {"volume": "long"})
        require_valid(clean, named)
        touched = spark.createDataFrame([(t,) for t in built + gone], "ticker string")
        clean_version = clean_table.write_groups(clean, touched)
        load = bars_table.load(clean_table.read(groups=named), KEY, VALUES)
        changed = spark.createDataFrame([(t,) for t in load["changed"]], "ticker string")
        metrics_version = metrics_table.version()
        if load["changed"]:
            metrics_version = metrics_table.write_groups(bars.bar_metrics(bars_table.read(groups=changed)), changed)
        recorded_version = versions.write_manifest(now, recorded_base)
    finally:
        now.unpersist()
    log.info("rebuild: %d built, %d dropped, %d kept; %d new, %d replaced bars", len(built), len(gone), kept, load["inserted"], load["updated"])
    return BarsRebuild(built, gone, kept, clean_version, metrics_version, recorded_version, load)


def metrics_view(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """The ticker metrics over a written snapshot."""
    return bars.bar_metrics(spark.read.parquet(snapshot_path))


def main(argv: Sequence[str] | None = None) -> int:
    import argparse

    from tidemark.session import cores_of, local_session

    ap = argparse.ArgumentParser(prog="python -m tidemark.plans.bars_chain")
    ap.add_argument("raw_path")
    ap.add_argument("snapshot_base")
    ap.add_argument("--tickers", default=None, help="comma-separated tickers that must be present")
    ap.add_argument("--arrival", default=None, help="column with a unique arrival number; dates must arrive in order")
    ap.add_argument("--incremental", default=None, metavar="REQUEST",
                    help="redo only what differs from the manifest; REQUEST names period and interval of the download, e.g. 5y/1d")
    ap.add_argument("--force", action="store_true", help="with --incremental: rebuild every ticker")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s  %(message)s", datefmt="%H:%M:%S")
    if args.master:
        spark = local_session(cores=cores_of(args.master))
    else:
        spark = SparkSession.builder.appName("tidemark-bars-chain").getOrCreate()
    wanted = [t.strip() for t in args.tickers.split(",")] if args.tickers else None
    try:
        raw = spark.read.parquet(args.raw_path)
        if args.incremental:
            bars_rebuild(spark, raw, args.snapshot_base, args.incremental, wanted, args.arrival, args.force)
            return 0
        run = bars_chain(spark, raw, args.snapshot_base, wanted, args.arrival)
    except (ValidationFailed, FileNotFoundError) as exc:
        log.error("%s", exc)
        return 1
    log.info("snapshot v=%d -> %s", run.version, run.snapshot)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
