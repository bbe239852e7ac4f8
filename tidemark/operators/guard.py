"""Writes that constraints guard (A12, K9): a version is published only if its rows satisfy the table's declaration.

    data/v=<n>/_state=table|quarantine/   the rows, split in one write
    versions/v=<n>/                       published versions: one line with the write's counts

Rows that break a rule go to the quarantine with the names of the rules they
break; counts are observed while the rows are written.  The gate then looks at
the share of such rows and at repeated keys.  A version that fails the gate is
there to be looked at, but no reader of the table ever sees it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources.schemas import TableType

STATE, BROKEN = "_state", "_broken"
TABLE, QUARANTINE = "table", "quarantine"


@dataclass(frozen=True)
class GuardedWrite:
    """What a guarded write did; ``violations`` counts the rows that break each rule."""

    version: int
    rows: int
    kept: int
    quarantined: int
    repeated: int
    violations: dict[str, int]
    published: bool


def _held(spark: SparkSession, base: str, version: int, columns: str, state: str) -> DataFrame:
    rows = spark.read.schema(f"{columns}, {STATE} string").parquet(f"{base}/data/v={version}")
    return rows.where(F.col(STATE) == state).drop(STATE)


def guarded_write(rows: DataFrame, base: str, table: TableType, max_bad_share: float = 0.0, allow_empty: bool = False) -> GuardedWrite:
    """Write ``rows`` (with at least the declared columns) as the next version under ``base``; publish it if the gate holds.

    The gate: at most ``max_bad_share`` of the rows break a rule, no two rows
    that stay share a key, and there are rows (unless ``allow_empty``).
    """
    spark, rules = rows.sparkSession, table.rules()
    missing = [f.name for f in table.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"{table.name} is missing columns: {', '.join(missing)}")
    number = max([*merge.snapshot_versions(spark, f"{base}/data"), *merge.snapshot_versions(spark, f"{base}/versions")], default=-1) + 1
    fails = [~F.coalesce(r.holds, F.lit(True)) for r in rules]
    names = F.array_compact(F.array(*[F.when(f, F.lit(r.name)) for f, r in zip(fails, rules)]))
    marked = rows.select(*[F.col(f.name).cast(f.kind).alias(f.name) for f in table.fields]).withColumn(BROKEN, names)
    marked = marked.withColumn(STATE, F.when(F.size(BROKEN) == 0, TABLE).otherwise(QUARANTINE))
    seen = Observation("guarded write")
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(STATE) == TABLE).alias("kept")]
    counts += [F.count_if(F.array_contains(BROKEN, r.name)).alias(f"rule_{k}") for k, r in enumerate(rules)]
    marked.observe(seen, *counts).write.partitionBy(STATE).parquet(f"{base}/data/v={number}")
    told = seen.get
    keys = _held(spark, base, number, table.ddl, TABLE).groupBy(*table.key).agg(F.count(F.lit(1)).alias("n"))
    repeated = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
    bad = told["rows"] - told["kept"]
    published = repeated == 0 and bad <= max_bad_share * told["rows"] and (told["rows"] > 0 or allow_empty)
    if published:
        line = [(number, told["rows"], told["kept"], bad)]
        spark.createDataFrame(line, "version int, rows bigint, kept bigint, quarantined bigint").coalesce(1).write.parquet(f"{base}/versions/v={number}")
    return GuardedWrite(number, told["rows"], told["kept"], bad, repeated, {r.name: told[f"rule_{k}"] for k, r in enumerate(rules)}, published)


def published_version(spark: SparkSession, base: str) -> int | None:
    return max((n for n, whole in merge.snapshot_versions(spark, f"{base}/versions").items() if whole), default=None)


def read_published(spark: SparkSession, base: str, table: TableType) -> DataFrame:
    """The rows of the newest published version; none if there is none."""
    version = published_version(spark, base)
    return spark.createDataFrame([], table.ddl) if version is None else _held(spark, base, version, table.ddl, TABLE)


def read_quarantine(spark: SparkSession, base: str, table: TableType, version: int) -> DataFrame:
    """A version's rows that break rules, with the names of those (``_broken``); also of versions that were not published."""
    return _held(spark, base, version, f"{table.ddl}, {BROKEN} array<string>", QUARANTINE)
