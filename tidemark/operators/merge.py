"""Keyed upsert, content fingerprints and input staleness.

Plain parquet has no transactions, so an upsert never rewrites the table it
reads: ``classify_upsert`` is a lazy FULL OUTER join of the current snapshot
and the incoming batch (one scan of each), ``upsert`` gives the next snapshot
together with counts that are observed while it is written, and
``write_snapshot`` lands it in a new directory; readers switch by path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import KEY, keyed, keyed_join, lookup_join, measured_bytes

# The four outcomes of a keyed load.
INSERTED, UPDATED, UNCHANGED, RETAINED = "inserted", "updated", "unchanged", "retained"
# A batch that measures at most this many bytes may be broadcast instead of shuffling the target.
DEFAULT_BATCH_BYTES = 8 << 20


# Names shown in an error.
SHOWN = 20


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (partial aggregation)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: Sequence[str]) -> None:
    """Raise when a key repeats: a keyed load cannot apply two rows to one key."""
    sample = duplicate_keys(df, key).limit(5).collect()
    if sample:
        shown = ", ".join(str(tuple(r[k] for k in key)) for r in sample)
        raise DuplicateKeyError(f"incoming batch repeats keys, e.g. {shown}")


def _changed(values: Sequence[str]) -> Column:
    cond = F.lit(False)
    for v in values:
        cond = cond | ~F.col(f"_t_{v}").eqNullSafe(F.col(f"_i_{v}"))
    return cond


def _sides(target: DataFrame, incoming: DataFrame, key: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both inputs with the key as a struct (NULL equals NULL) and their values renamed."""
    return tuple(
        keyed(df, key).select(KEY, F.lit(True).alias(f"_in_{side}"), *[F.col(v).alias(f"_{side}_{v}") for v in values])
        for side, df in (("t", target), ("i", incoming))
    )


def classify_upsert(target: DataFrame, incoming: DataFrame, key: Sequence[str], values: Sequence[str],
                    broadcast_bytes: int | None = None) -> DataFrame:
    """One row per key of either side: key columns, ``action``, and both versions.

    inserted: only incoming has the key; updated: both, some value IS DISTINCT
    FROM; unchanged: both, all values equal (NULL equals NULL); retained: only
    the target has it. A NULL in a key equals a NULL.

    Both sides are scanned once and shuffled on the key for one FULL OUTER
    join. With ``broadcast_bytes`` set and a batch that measures no more (one
    aggregation over it), the target is not shuffled: it meets the broadcast
    batch in a left join, and the inserted rows are the batch minus the target's
    keys, for which only the key columns are read again.
    """
    key, values = list(key), list(values)
    t, i = _sides(target, incoming, key, values)
    if broadcast_bytes is not None and measured_bytes(incoming.select(*key, *values)) <= broadcast_bytes:
        both = t.join(F.broadcast(i), KEY, "left")
        # Keys of the target that the batch has: no more of them than the batch has rows.
        known = t.select(KEY).join(F.broadcast(i.select(KEY)), KEY, "left_semi")
        new = i.join(known, KEY, "left_anti")
        j = both.unionByName(new, allowMissingColumns=True)
    else:
        j = t.join(i, KEY, "full")
    action = (
        F.when(F.col("_in_t").isNull(), F.lit(INSERTED))
        .when(F.col("_in_i").isNull(), F.lit(RETAINED))
        .when(_changed(values), F.lit(UPDATED))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.select(*[F.col(f"{KEY}.{k}").alias(k) for k in key], *[c for c in j.columns if c != KEY], action.alias("action"))


def snapshot_from(classified: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The table after the load: incoming wins where present, the target elsewhere."""
    return classified.select(
        *key,
        *[F.when(F.col("_in_i").isNotNull(), F.col(f"_i_{v}")).otherwise(F.col(f"_t_{v}")).alias(v) for v in values],
    )


def upsert_snapshot(target: DataFrame, incoming: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    return snapshot_from(classify_upsert(target, incoming, key, values), key, values)


def _load_counts(date: str) -> list[Column]:
    return [
        *[F.count_if(F.col("action") == a).alias(a) for a in (INSERTED, UPDATED, UNCHANGED, RETAINED)],
        F.count(F.lit(1)).alias("total"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    ]


def load_report(classified: DataFrame, date: str = "date") -> DataFrame:
    """inserted, updated, unchanged, retained, total rows after, first and last date."""
    return classified.agg(*_load_counts(date))


def upsert(target: DataFrame, incoming: DataFrame, key: Sequence[str], values: Sequence[str],
           check_keys: bool = True, date: str = "date") -> tuple[DataFrame, Observation]:
    """(next snapshot, its load report) for a stored snapshot and a batch.

    The report's counts are taken while the snapshot is written: read
    ``report.get`` after the write. Raises on a repeated key in ``incoming``.
    """
    if check_keys:
        require_unique(incoming, key)
    report = Observation("load")
    classified = classify_upsert(target, incoming, key, values).observe(report, *_load_counts(date))
    return snapshot_from(classified, key, values), report


def snapshot_versions(spark: SparkSession, base_path: str) -> dict[int, bool]:
    """Version -> whether it was written to its end (has ``_SUCCESS``); lists one folder level."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    found = {}
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            found[int(name[2:])] = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
    return found


def write_snapshot(snapshot: DataFrame, base_path: str, version: int, partition_by: Sequence[str] = ()) -> str:
    """Write the next snapshot to ``base_path/v=<version>``; never overwrite the one being read."""
    path = f"{base_path.rstrip('/')}/v={int(version)}"
    w = snapshot.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# --- fingerprints (A11) -------------------------------------------------------------

def canonical_text(column: str, dtype: str) -> Column:
    """A text of a value that any engine can make: NULL is ``N``, others are ``length:text``.

    Floating values are written in hexadecimal (``0x1.8p3``), which is the value
    to its last bit; the two zeros are equal, NaN and infinities have their names.
    """
    c = F.col(column)
    text = c.cast("string")
    if dtype in ("double", "float"):
        text = F.regexp_replace(F.format_string("%a", c.cast("double") + 0.0), r"\.0p", "p")
    return F.when(c.isNull(), F.lit("N")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def row_hash(cols: Sequence[str], dtypes: dict[str, str]) -> Column:
    """A 60-bit hash (md5 prefix) of the row's canonical texts; their lengths keep neighbouring columns apart."""
    text = F.concat(*[canonical_text(c, dtypes[c]) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Per group: rows, sum and xor of row hashes - independent of order and file layout.

    Sum and xor are algebraic, so groups of any size aggregate map-side.
    """
    by = list(by)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    h = row_hash(cols, dict(df.dtypes))
    return df.select(*by, h.alias("_h")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("_h").cast("decimal(38,0)").cast("string").alias("hash_sum"),
        F.bit_xor(F.col("_h").cast("long")).alias("hash_xor"),
    )


# What can have happened to an input since it was recorded.
ADDED, CHANGED, REMOVED, SAME = "added", "changed", "removed", "unchanged"
MARKS = ("rows", "hash_sum", "hash_xor")


def changed_groups(new: DataFrame, recorded: DataFrame, by: Sequence[str], force: bool = False) -> DataFrame:
    """Every group of either side with its ``status`` and whether what is built from it must be rebuilt.

    A group that is no longer there counts as a change: what was built from it
    is out of date. ``force`` marks every group. A NULL key is a group like
    any other.
    """
    by = list(by)
    now = keyed(new, by).select(KEY, F.lit(True).alias("_now"), *MARKS)
    then = keyed(recorded, by).select(KEY, F.lit(True).alias("_then"), *[F.col(c).alias(f"_then_{c}") for c in MARKS])
    same = F.lit(True)
    for c in MARKS:
        same = same & F.col(c).eqNullSafe(F.col(f"_then_{c}"))
    status = F.when(F.col("_then").isNull(), ADDED).when(F.col("_now").isNull(), REMOVED).when(same, SAME).otherwise(CHANGED)
    j = now.join(then, KEY, "full").withColumn("status", status)
    changed = F.lit(bool(force)) | (F.col("status") != SAME)
    return j.select(*[F.col(f"{KEY}.{k}").alias(k) for k in by], *MARKS, "status", changed.alias("changed"))


# --- staleness and missing inputs (A10, C4, C6) -----------------------------------------

def stale_inputs(wanted: DataFrame, manifest: DataFrame, today, period: str, interval: str,
                 force: bool = False, name: str = "input") -> DataFrame:
    """Per wanted input: stale unless present, fetched today, same period and interval (A10).

    ``today`` is a date or a Column (e.g. a scalar subquery), never read from a clock.

    ``manifest`` has one row per input (input, fetched_on, period, interval, ...);
    it is joined after a size check (C4).
    """
    m = manifest.select(
        F.col(name), F.lit(True).alias("_present"), F.col("fetched_on").alias("_fetched_on"),
        F.col("period").alias("_period"), F.col("interval").alias("_interval"),
    )
    j = lookup_join(wanted.select(name).distinct(), m, name, "left")
    today = today if isinstance(today, Column) else F.lit(today)
    reason = (
        F.when(F.lit(bool(force)), F.lit("forced"))
        .when(F.col("_present").isNull(), F.lit("missing"))
        .when(~F.col("_fetched_on").eqNullSafe(today), F.lit("old"))
        .when(~F.col("_period").eqNullSafe(F.lit(period)) | ~F.col("_interval").eqNullSafe(F.lit(interval)),
              F.lit("different_request"))
    )
    return j.select(name, reason.isNotNull().alias("stale"), reason.alias("reason"))


def missing_inputs(wanted: DataFrame, available: DataFrame, name: str = "input") -> DataFrame:
    """Wanted names with no entry in ``available`` (C6): a left anti join."""
    return wanted.select(name).distinct().join(available.select(name).distinct(), name, "left_anti")


def require_inputs(wanted: DataFrame, available: DataFrame, name: str = "input") -> None:
    """Raise naming the first of the missing inputs and their number."""
    missing = missing_inputs(wanted, available, name)
    first = [r[name] for r in missing.orderBy(name).limit(SHOWN).collect()]
    if first:
        raise FileNotFoundError(f"{missing.count()} input(s) not available yet: {', '.join(map(str, first))}")
