"""Versioned tables in which a change rewrites only the groups it touches.

A table lives in one folder:

    data/v=<n>/_group=<mark>/    the rows of the groups that version n wrote
    versions/v=<n>/              version n: one line per group, naming the version that wrote it

A version is there once its lines are (``_SUCCESS`` of ``versions/v=<n>``), so
readers see a whole version or the one before.  Groups that a version did not
touch keep their folders; nothing is copied, and earlier versions stay readable.
A folder's mark is the digest of the group's value, so any value, NULL too, has
a folder of its own.

The driver holds a line per group of what it reads, as for any list of files:
group by what has at most some 100,000 values (a ticker, or a bucket of
tickers).  A group of any size is written by many tasks (``rebalance`` splits
it), so its size is no limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.joins import keyed_join

MARK = "_group"


def mark_of(group: str) -> Column:
    """Folder mark of a group: digest of its value, with NULL told from every text."""
    text = F.col(group).cast("string")
    return F.md5(F.when(text.isNull(), F.lit("N")).otherwise(F.concat(F.lit("v"), text)))


def only_groups(df: DataFrame, groups: DataFrame, group: str, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose group is (``left_semi``) or is not (``left_anti``) among ``groups``; NULL equals NULL."""
    return keyed_join(df, groups.select(group), [group], how)


@dataclass(frozen=True)
class VersionedTable:
    """A table of rows with ``columns`` (DDL) in ``base``, by ``group``, dated by ``date``."""

    spark: SparkSession
    base: str
    columns: str
    group: str
    date: str

    def _names(self) -> list[str]:
        return self.spark.createDataFrame([], self.columns).columns

    def version(self) -> int | None:
        """The newest whole version."""
        return max((n for n, whole in merge.snapshot_versions(self.spark, f"{self.base}/versions").items() if whole), default=None)

    def _next(self) -> int:
        """Past every folder there is, so that a run which died does not block its number."""
        taken = [*merge.snapshot_versions(self.spark, f"{self.base}/versions"), *merge.snapshot_versions(self.spark, f"{self.base}/data")]
        return max(taken, default=-1) + 1

    def lines(self, version: int | None = None) -> DataFrame:
        """The version's groups: group, mark, written (version that wrote it), rows, first and last date."""
        version = self.version() if version is None else version
        kinds = self.spark.createDataFrame([], self.columns).schema
        schema = (
            f"`{self.group}` {kinds[self.group].dataType.simpleString()}, mark string, written int, rows bigint, "
            f"first_date {kinds[self.date].dataType.simpleString()}, last_date {kinds[self.date].dataType.simpleString()}"
        )
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.base}/versions/v={version}")

    def read(self, version: int | None = None, groups: DataFrame | None = None) -> DataFrame:
        """The rows of a version (the newest), or of some of its groups; no other folder is listed."""
        lines = self.lines(version)
        if groups is not None:
            lines = only_groups(lines, groups, self.group)
        paths = [f"{self.base}/data/v={r['written']}/{MARK}={r['mark']}" for r in lines.select("written", "mark").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.columns)
        return self.spark.read.schema(self.columns).parquet(*sorted(paths))

    def write_groups(self, rows: DataFrame, touched: DataFrame) -> int:
        """The next version: the ``touched`` groups hold exactly ``rows``, all others stay as they are.

        A touched group without rows is gone from the version.
        """
        held, number = self.version(), self._next()
        data = f"{self.base}/data/v={number}"
        rows.select(*self._names(), mark_of(self.group).alias(MARK)).hint("rebalance", MARK).write.partitionBy(MARK).parquet(data)
        written = self.spark.read.schema(f"{self.columns}, {MARK} string").parquet(data)
        new = written.groupBy(self.group, MARK).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self.date).alias("first_date"), F.max(self.date).alias("last_date")
        ).select(self.group, F.col(MARK).alias("mark"), F.lit(number).alias("written"), "rows", "first_date", "last_date")
        kept = only_groups(self.lines(held), touched, self.group, "left_anti")
        kept.unionByName(new).coalesce(1).write.mode("errorifexists").parquet(f"{self.base}/versions/v={number}")
        return number

    def load(self, incoming: DataFrame, key: Sequence[str], values: Sequence[str]) -> dict:
        """Keyed load (A7, C3, D13): new keys are inserted, differing rows replaced, all others stay.

        Only the batch's groups are read, and of them only those in which a row
        is new or differs are written; a batch without news writes nothing.
        The report has the counts of the whole table, the version, and the
        groups read and written.
        """
        merge.require_unique(incoming, key)
        batch = incoming.select(self.group).distinct()
        target = self.read(groups=batch)
        classified = merge.classify_upsert(target, incoming, key, values)
        actions = [F.count_if(F.col("action") == a).alias(a) for a in (merge.INSERTED, merge.UPDATED, merge.UNCHANGED, merge.RETAINED)]
        found = classified.groupBy(self.group).agg(*actions, F.min(self.date).alias("first_date"), F.max(self.date).alias("last_date")).collect()
        changed = [(r[self.group],) for r in found if r[merge.INSERTED] + r[merge.UPDATED]]
        others = only_groups(self.lines(), batch, self.group, "left_anti").agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
        ).first()
        version = self.version()
        if changed:
            kind = incoming.schema[self.group].dataType.simpleString()
            touched = self.spark.createDataFrame(changed, f"`{self.group}` {kind}")
            after = merge.snapshot_from(merge.classify_upsert(
                only_groups(target, touched, self.group), only_groups(incoming, touched, self.group), key, values), key, values)
            version = self.write_groups(after, touched)
        report = {a: sum(r[a] for r in found) for a in (merge.INSERTED, merge.UPDATED, merge.UNCHANGED, merge.RETAINED)}
        report[merge.RETAINED] += others["rows"]
        dates = [d for r in [*found, others] for d in (r["first_date"], r["last_date"]) if d is not None]
        return report | {
            "total": sum(report.values()), "first_date": min(dates, default=None), "last_date": max(dates, default=None),
            "version": version, "groups_read": len(found), "groups_written": len(changed), "changed": [g for g, in changed],
        }


# --- rebuild by manifest (A9, A11) ----------------------------------------------------

# What a run does with an input.
BUILD, DROP, KEEP = "build", "drop", "keep"


def manifest_of(inputs: DataFrame, group: str, request: str, cols: Sequence[str] | None = None) -> DataFrame:
    """The manifest of inputs as they are: fingerprint of each group and what was asked for."""
    return merge.fingerprint(inputs, [group], cols).withColumn("request", F.lit(request))


def rebuild_plan(now: DataFrame, recorded: DataFrame, group: str, force: bool = False) -> DataFrame:
    """Per group of either manifest: ``status`` against the record and the ``action`` of the run.

    Added and changed inputs are built, and those recorded for another request;
    what was built from a removed input is dropped; all else is kept.
    ``force`` builds whatever is there.
    """
    states = merge.changed_groups(now, recorded, [group])
    asked = keyed_join(
        now.select(group, F.col("request").alias("_now")), recorded.select(group, F.col("request").alias("_then")), [group]
    ).select(group, (~F.col("_now").eqNullSafe(F.col("_then"))).alias("other_request"))
    j = keyed_join(states, asked, [group], "left")
    status = F.when((F.col("status") == merge.SAME) & F.col("other_request"), "different_request").otherwise(F.col("status"))
    action = F.when(F.col("status") == merge.REMOVED, DROP).when(F.lit(bool(force)) | (status != merge.SAME), BUILD).otherwise(KEEP)
    return j.select(group, "rows", status.alias("status"), action.alias("action"))


def read_manifest(spark: SparkSession, base: str, like: DataFrame) -> DataFrame:
    """The newest whole manifest under ``base``; empty (with the columns of ``like``) if there is none."""
    done = [n for n, whole in merge.snapshot_versions(spark, base).items() if whole]
    return spark.read.schema(like.schema).parquet(f"{base}/v={max(done)}") if done else spark.createDataFrame([], like.schema)


def write_manifest(manifest: DataFrame, base: str) -> int:
    """Record what a run was built from, after all else of it is written."""
    number = max(merge.snapshot_versions(manifest.sparkSession, base), default=-1) + 1
    merge.write_snapshot(manifest, base, number)
    return number
