"""Tie-safe series features over (entity, category) histories (inventory E1-E6).

A plain ``Window.partitionBy(entity, category).orderBy(date)`` sends a whole
series to one task. That is the fastest plan while every series is of modest
size, and a disaster for a series holding a third of the table. So series are
split by size first (one partial aggregation of row counts per series, of
which only the largest count and the total reach the driver):

* while no series exceeds ``hot_rows`` rows, all run through plain windows;
* otherwise the series above ``max(hot_rows, total / MAX_HOT_KEYS)`` rows - by
  that bound never more than ``MAX_HOT_KEYS`` of them, so their keys can be
  broadcast - are cut into *blocks*: rows of one day whose tie-break ``seq``
  falls in the same ``block_rows``-wide range. Since ``seq`` is unique, a block
  holds at most ``block_rows`` rows. The others stay in plain windows.

The blocked path:

1. One partial aggregation per block (count, flags, exact decimal sums, last
   value) - map-side combined - and from it one per day.
2. Windows over a series' *days* (at most the calendar's days) give what crosses
   days: rows and flags before the day, the last value before it, the
   calendar-range mean and the whole-series moments. Windows over a day's
   *blocks* (at most seq span / block_rows) give what crosses blocks.
3. Row-level windows run per block only (row number, lag, running flag count),
   then the block facts are joined on the block key. The rows are shuffled
   once, on the block key, and the join reuses that partitioning.

No task of the blocked path holds more than ``max(days, seq span / block_rows,
block_rows)`` rows of a series. A NULL key is a series like any other: keys are
compared as structs, in which NULL equals NULL.

Both paths produce identical rows (tests force each one). Order within a
series is (date, seq); ``seq`` must be a unique integer.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import dec, mean_from, measure, round3, sd_from
from tidemark.operators.joins import KEY, keyed, keyed_join

DEFAULT_BLOCK_ROWS = 1 << 20
DEFAULT_HOT_ROWS = 1 << 22
MAX_HOT_KEYS = 100_000
EPOCH = _dt.date(1970, 1, 1)


def tuned(df: DataFrame, value: int | None, conf_key: str, default: int) -> int:
    """An explicit argument, else the session conf ``conf_key``, else the default."""
    if value is not None:
        return value
    configured = df.sparkSession.conf.get(conf_key, None)
    return int(configured) if configured else default


INTEGRAL_TYPES = ("tinyint", "smallint", "int", "bigint")
NULLS_FIRST = -(1 << 62)  # block coordinate of a NULL: sorts first, as NULLS FIRST does
NULL_DAY = -(1 << 30)  # likewise for day numbers (an int; real dates are above -719163)


def floor_div(col: str, width: int) -> Column:
    """Integer floor division, monotone across zero; NULL maps below every value."""
    c = f"CAST(`{col}` AS BIGINT)"
    return F.coalesce(F.expr(f"({c} - pmod({c}, {int(width)})) div {int(width)}"), F.lit(NULLS_FIRST))


def require_integral(df: DataFrame, col: str) -> None:
    if dict(df.dtypes).get(col) not in INTEGRAL_TYPES:
        raise TypeError(f"{col!r} must be an integer column to cut blocks, got {dict(df.dtypes).get(col)}")


def day_number(col: str) -> Column:
    return F.datediff(F.col(col), F.lit(EPOCH))


def day_block(col: str) -> Column:
    """Day number for block keys: a NULL date sorts first, as NULLS FIRST does."""
    return F.coalesce(day_number(col), F.lit(NULL_DAY))


def series_features(
    df: DataFrame,
    keys: Sequence[str] = ("sensor_id", "parameter"),
    date: str = "reading_date",
    tie: str = "seq",
    value: str = "value",
    flag: Column | None = None,
    days: int = 7,
    block_rows: int | None = None,
    hot_rows: int | None = None,
    decimals: int = 3,
) -> DataFrame:
    """Add reading_no, prev_value, delta, rolling_avg_{days}d, bad_so_far, z_score.

    * reading_no: 1-based position in the series ordered by (date, tie)
    * prev_value / delta: previous reading and the exact difference (NULL first)
    * rolling_avg: mean over the trailing ``days`` calendar days, all same-day
      peers included, at 3 dp
    * bad_so_far: running count of flagged readings, current row included
    * z_score: (value - series mean) / series sample sd at 3 dp; NULL when the
      sd is NULL or 0

    ``decimals`` is how many the values have; more are an error, never rounded.
    Series with more than ``hot_rows`` rows take the blocked path;
    ``hot_rows=0`` sends every series there. Unset, ``hot_rows`` and
    ``block_rows`` come from the session confs ``tidemark.hotRows`` and
    ``tidemark.blockRows``, else 4M and 1M.
    """
    hot_rows = tuned(df, hot_rows, "tidemark.hotRows", DEFAULT_HOT_ROWS)
    block_rows = tuned(df, block_rows, "tidemark.blockRows", DEFAULT_BLOCK_ROWS)
    require_integral(df, tie)
    if days < 1:
        raise ValueError("days must be at least 1")
    if block_rows < 1 or hot_rows < 0:
        raise ValueError("block_rows must be positive and hot_rows not negative")
    keys = list(keys)
    flag = (F.col("status") == "Bad") if flag is None else flag
    args = (keys, date, tie, value, flag, days, measure(decimals))
    if hot_rows == 0:
        return _blocked_features(df, *args, block_rows)
    hot = hot_series(df, keys, hot_rows)
    if hot is None:
        return _plain_features(df, *args)
    cold, warm = routed(df, hot, keys)
    return _plain_features(cold, *args).unionByName(_blocked_features(warm, *args, block_rows))


def hot_series(df: DataFrame, keys: Sequence[str], hot_rows: int, max_keys: int = MAX_HOT_KEYS) -> DataFrame | None:
    """The keys of the hot series, a lazy frame of at most ``max_keys`` rows; None when there is none.

    A series is hot above ``hot_rows`` rows and above ``total / max_keys``, which
    bounds the number of hot keys whatever the table holds. One job runs now:
    the largest and the total of the per-series counts.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most, total = counts.agg(F.max("_rows"), F.sum("_rows")).first()
    bound = max(hot_rows, -(-(total or 0) // max_keys))
    return None if (most or 0) <= bound else counts.where(F.col("_rows") > bound).select(*keys)


def routed(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of other series, rows of hot series); a NULL key is matched like any other."""
    return tuple(keyed_join(df, hot, keys, how, broadcast_right=True).select(*df.columns) for how in ("left_anti", "left_semi"))


def _plain_features(
    df: DataFrame, keys: list[str], date: str, tie: str, value: str, flag: Column, days: int, kind: str
) -> DataFrame:
    """Per-series windows; used only for series of at most ``hot_rows`` rows."""
    x = dec(value, kind)
    series = Window.partitionBy(*keys)
    history = series.orderBy(date, tie)
    prev = F.lag(value).over(history)
    n, s1, s2 = F.count(x).over(series), F.sum(x).over(series), F.sum(x * x).over(series)
    # A RANGE frame ordered by the date itself (an interval offset), so the sort
    # on (keys, date, seq) that the row frames need also serves this frame.
    calendar = (
        f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY `{date}` "
        f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"
    )
    xs = f"CAST(`{value}` AS {kind})"
    rolling = mean_from(F.expr(f"count({xs}) {calendar}"), F.expr(f"sum({xs}) {calendar}"))
    return df.select(
        *df.columns,
        F.row_number().over(history).alias("reading_no"),
        prev.alias("prev_value"),
        (x - dec(prev, kind)).cast("double").alias("delta"),
        round3(rolling).alias(f"rolling_avg_{days}d"),
        F.sum(flag.cast("int")).over(history.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("bad_so_far"),
        round3((F.col(value) - mean_from(n, s1)) / F.nullif(sd_from(n, s1, s2), F.lit(0.0))).alias("z_score"),
    )


def _blocked_features(
    df: DataFrame,
    keys: list[str],
    date: str,
    tie: str,
    value: str,
    flag: Column,
    days: int,
    kind: str,
    block_rows: int,
) -> DataFrame:
    """The blocked path; see the module text for the bound of its tasks."""
    keys = list(keys)
    cols = df.columns
    x = dec(value, kind)
    blk_key = keys + ["_day", "_blk"]

    base = df.select(
        *cols,
        day_block(date).alias("_day"),
        floor_div(tie, block_rows).alias("_blk"),
        flag.cast("int").alias("_flag"),
    )

    blocks = base.groupBy(*blk_key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(x).alias("_nx"),
        F.sum("_flag").alias("_bad"),
        F.sum(x).alias("_s1"),
        F.sum(x * x).alias("_s2"),
        F.max_by(value, F.coalesce(F.col(tie).cast("long"), F.lit(NULLS_FIRST))).alias("_last"),
    )
    per_day = blocks.groupBy(*keys, "_day").agg(
        *[F.sum(c).alias(f"_d{c}") for c in ("_n", "_nx", "_bad", "_s1", "_s2")],
        F.max_by("_last", "_blk").alias("_d_last"),
    )
    series = Window.partitionBy(*keys)
    ordered = series.orderBy("_day")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    calendar = ordered.rangeBetween(-(days - 1), 0)
    n, s1, s2 = F.sum("_d_nx"), F.sum("_d_s1"), F.sum("_d_s2")
    day_facts = per_day.select(
        *keys, "_day",
        F.coalesce(F.sum("_d_n").over(before), F.lit(0)).alias("_n_days"),
        F.coalesce(F.sum("_d_bad").over(before), F.lit(0)).alias("_bad_days"),
        F.lag("_d_last").over(ordered).alias("_last_day"),
        mean_from(n.over(calendar), s1.over(calendar)).alias("_roll"),
        mean_from(n.over(series), s1.over(series)).alias("_mean"),
        sd_from(n.over(series), s1.over(series), s2.over(series)).alias("_sd"),
    )
    in_day = Window.partitionBy(*keys, "_day").orderBy("_blk")
    earlier = in_day.rowsBetween(Window.unboundedPreceding, -1)
    within = blocks.select(
        *blk_key,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_here"),
        F.coalesce(F.sum("_bad").over(earlier), F.lit(0)).alias("_bad_here"),
        F.row_number().over(in_day).alias("_nth"),
        F.lag("_last").over(in_day).alias("_last_here"),
    )
    block_facts = keyed_join(within, day_facts, [*keys, "_day"]).select(
        *blk_key,
        (F.col("_n_days") + F.col("_n_here")).alias("_n_before"),
        (F.col("_bad_days") + F.col("_bad_here")).alias("_bad_before"),
        F.when(F.col("_nth") == 1, F.col("_last_day")).otherwise(F.col("_last_here")).alias("_prev_last"),
        "_roll", "_mean", "_sd",
    )

    # The window and the join share one partitioning: the block key as a struct.
    local = Window.partitionBy(KEY).orderBy(tie)
    rows = keyed(base, blk_key).select(
        *cols, KEY,
        F.row_number().over(local).alias("_rn"),
        F.lag(value).over(local).alias("_lag"),
        F.sum("_flag").over(local.rowsBetween(Window.unboundedPreceding, 0)).alias("_bad_run"),
    )
    joined = rows.join(keyed(block_facts, blk_key).drop(*blk_key), KEY)
    prev = F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col("_lag"))
    return joined.select(
        *cols,
        (F.col("_n_before") + F.col("_rn")).cast("int").alias("reading_no"),
        prev.alias("prev_value"),
        (x - dec(prev, kind)).cast("double").alias("delta"),
        round3("_roll").alias(f"rolling_avg_{days}d"),
        (F.col("_bad_before") + F.col("_bad_run")).cast("int").alias("bad_so_far"),
        round3((F.col(value) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))).alias("z_score"),
    )


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str] = ("sensor_id", "parameter"),
    date: str = "reading_date",
    value: str = "value",
    days: int = 7,
    decimals: int = 3,
) -> DataFrame:
    """Trailing calendar-day mean per (keys, date), recomputed from raw values.

    One row per (keys, date): a partial aggregation to days, then a RANGE frame
    over the day table, which is at most one row per key per calendar day.
    """
    keys = list(keys)
    x = dec(value, measure(decimals))
    per_day = df.groupBy(*keys, date).agg(F.count(x).alias("_n"), F.sum(x).alias("_s1"))
    frame = Window.partitionBy(*keys).orderBy(day_number(date)).rangeBetween(-(days - 1), 0)
    return per_day.select(
        *keys, date,
        round3(mean_from(F.sum("_n").over(frame), F.sum("_s1").over(frame))).alias("expected"),
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    block_rows: int | None = None,
    out: str = "prev",
    hot_rows: int | None = None,
) -> DataFrame:
    """``lag(value) over (partition by keys order by order)`` without an unbounded task.

    Keys with at most ``hot_rows`` rows use the plain window; hotter keys
    (``hot_rows=0``: all) are cut into blocks of ``block_rows`` consecutive
    order values (``order`` must be a unique integer within a key), and the
    first row of a block takes the last value of the previous non-empty block,
    found on the block table (order span / block_rows rows of a key).
    """
    keys = list(keys)
    hot_rows = tuned(df, hot_rows, "tidemark.hotRows", DEFAULT_HOT_ROWS)
    block_rows = tuned(df, block_rows, "tidemark.blockRows", DEFAULT_BLOCK_ROWS)
    require_integral(df, order)
    def plain(part: DataFrame) -> DataFrame:
        return part.select(*part.columns, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)).alias(out))

    if hot_rows:
        hot = hot_series(df, keys, hot_rows)
        if hot is None:
            return plain(df)
        cold, warm = routed(df, hot, keys)
        return plain(cold).unionByName(previous_value(warm, keys, order, value, block_rows, out, hot_rows=0))
    blk_key = [*keys, "_pblk"]
    base = df.withColumn("_pblk", floor_div(order, block_rows))
    last = base.groupBy(*blk_key).agg(
        F.max_by(value, F.coalesce(F.col(order).cast("long"), F.lit(NULLS_FIRST))).alias("_last"))
    last = last.select(*blk_key, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_pblk")).alias("_prev_last"))
    local = Window.partitionBy(KEY).orderBy(order)
    rows = keyed(base, blk_key).select(
        *df.columns, KEY,
        F.row_number().over(local).alias("_rn"),
        F.lag(value).over(local).alias("_lag"),
    )
    joined = rows.join(keyed(last, blk_key).select(KEY, "_prev_last"), KEY)
    prev = F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col("_lag"))
    return joined.select(*df.columns, prev.alias(out))
