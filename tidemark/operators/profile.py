"""Grouped profiles and counting aggregates (inventory D1-D8).

Every aggregate here is algebraic or a bounded sketch (counts, exact decimal
sums, min/max, HLL, quantile summaries), so Spark runs a partial aggregation in
each map task and shuffles one small buffer per group per task: a group holding
a third of all rows costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_mean, exact_stddev, measure, percent, round3, round_to
from tidemark.operators.joins import keyed_join
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.schemas import READINGS_FEATURES

#: The columns in which a reading holds a value.
REQUIRED = tuple(f.name for f in READINGS_FEATURES.fields[:6])
# The HLL error the profile asks for, and percentile accuracy.
APPROX_DISTINCT_RSD = 0.02
PERCENTILE_ACCURACY = 10_000
# The quantiles of the profile.
PROFILE_QUANTILES = {"median_value": 0.5, "p95_value": 0.95}


def _flag(flag: Column | str) -> Column:
    return F.col(flag) if isinstance(flag, str) else flag


def group_profile(
    df: DataFrame,
    keys: Sequence[str] = ("location", "parameter"),
    value: str = "value",
    flag: Column | None = None,
    entity: str = "sensor_id",
    date: str = "reading_date",
    distinct: str = "exact",
    quantiles: str = "approx",
    decimals: int = 3,
) -> DataFrame:
    """One row per group with the eleven measures of the location profile.

    readings, sensors (exact distinct, or an HLL sketch with ``distinct="approx"``),
    avg/stddev/median/p95/min/max of ``value`` at 3 dp, bad_pct at 3 dp, first and
    last date. Mean and sd come from exact decimal moments, median and p95 from
    ``percentile_approx`` (a bounded sketch that merges partially) or, with
    ``quantiles="exact"``, from ``exact_quantiles``. ``decimals`` is how many the
    values have; more are an error, never rounded.
    """
    flag = F.col("status") == "Bad" if flag is None else _flag(flag)
    if distinct not in ("exact", "approx"):
        raise ValueError(f"distinct must be 'exact' or 'approx', got {distinct!r}")
    keys = list(keys)
    sensors = [] if distinct == "exact" else [F.approx_count_distinct(entity, rsd=APPROX_DISTINCT_RSD).alias("sensors")]
    if quantiles not in ("approx", "exact"):
        raise ValueError(f"quantiles must be 'approx' or 'exact', got {quantiles!r}")
    sketched = [] if quantiles == "exact" else [
        round3(F.percentile_approx(value, p, PERCENTILE_ACCURACY)).alias(c) for c, p in PROFILE_QUANTILES.items()]
    measures = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("readings"),
        *sensors,
        round3(exact_mean(value, measure(decimals))).alias("avg_value"),
        round3(exact_stddev(value, measure(decimals))).alias("stddev_value"),
        *sketched,
        round3(F.min(value)).alias("min_value"),
        round3(F.max(value)).alias("max_value"),
        round3(percent(F.count_if(flag), F.count(F.lit(1)))).alias("bad_pct"),
        F.min(date).alias("first_reading"),
        F.max(date).alias("last_reading"),
    )
    if quantiles == "exact":
        exact = exact_quantiles(df, keys, value, PROFILE_QUANTILES)
        before = measures.columns.index("min_value")
        order = [*measures.columns[:before], *PROFILE_QUANTILES, *measures.columns[before:]]
        joined = keyed_join(measures, exact, keys, "left")
        measures = joined.select(*[round3(c).alias(c) if c in PROFILE_QUANTILES else F.col(c) for c in order])
    if distinct == "approx":
        return measures
    # An exact distinct inside the same aggregate would make Spark group by
    # (keys, entity) first and carry every other aggregate - quantile sketches
    # included - per entity. Counting distinct entities on its own keeps that
    # to one small pre-aggregation of (keys, entity) pairs.
    entities = count_distinct_by(df, keys, entity, "sensors")
    cols = measures.columns
    joined = keyed_join(measures, entities, keys, "left")
    return joined.select(*cols[:3], F.coalesce(F.col("sensors"), F.lit(0)).alias("sensors"), *cols[3:])


def count_distinct_by(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """Exact distinct count of ``column`` per key: distinct pairs first, then a count."""
    keys = list(keys)
    pairs = df.select(*keys, column).where(F.col(column).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """``count(*) FILTER (WHERE cond)`` for several conditions in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(cond).alias(name) for name, cond in conditions.items()
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def arrival_summary(
    df: DataFrame,
    entity: str = "sensor_id",
    category: str = "parameter",
    date: str = "reading_date",
    required: Sequence[str] = REQUIRED,
) -> DataFrame:
    """Distinct entities, categories and days plus a null audit, one row."""
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_distinct(entity).alias("sensors"),
        F.count_distinct(category).alias("parameters"),
        F.count_distinct(date).alias("days"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
        F.count_if(any_null).alias("rows_with_nulls"),
    )


def display_profile(
    df: DataFrame, key: str = "parameter", value: str = "value", flag: Column | None = None, decimals: int = 3
) -> DataFrame:
    """Shape of the data per category, in category order: mean and sd at 3 dp, min/max at 2 dp."""
    flag = F.col("status") == "Bad" if flag is None else flag
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("readings"),
        round3(exact_mean(value, measure(decimals))).alias("mean"),
        round3(exact_stddev(value, measure(decimals))).alias("sd"),
        round_to(F.min(value), 2).alias("lowest"),
        round_to(F.max(value), 2).alias("highest"),
        round3(percent(F.count_if(flag), F.count(F.lit(1)))).alias("bad_pct"),
    ).orderBy(key)


def sequence_completeness(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Per series: count, distinct positions, lowest and highest position.

    A series is broken unless its positions are exactly 1..count.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_distinct(position).alias("positions"),
        F.min(position).alias("lowest"),
        F.max(position).alias("highest"),
    ).withColumn(
        "broken",
        (F.col("lowest") != 1) | (F.col("highest") != F.col("readings"))
        | (F.col("positions") != F.col("readings")),
    )


def dependency_violations(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """Per determinant value, how many distinct dependents it has."""
    return df.groupBy(determinant).agg(F.count_distinct(dependent).alias("dependents"))


# Size of a stored sketch, as a power of two: a relative error of 1.04 / sqrt(2 ** 14), 0.8 %.
SKETCH_BITS = 14
# Ranges of days asked for at once.
MAX_RANGES = 1_000


def daily_sketches(df: DataFrame, keys: Sequence[str], entity: str = "sensor_id", date: str = "reading_date") -> DataFrame:
    """An HLL sketch of the distinct entities per group and day (D1b, D5), to be stored.

    A day's sketch never changes once the day is over, so a table of them grows
    by a day at a time and no later question reads the rows again. NULL
    entities are not counted; a NULL key is a group.
    """
    return df.groupBy(*keys, date).agg(F.hll_sketch_agg(entity, F.lit(SKETCH_BITS)).alias("sketch"))


def distinct_between(sketches: DataFrame, keys: Sequence[str], ranges: DataFrame, date: str = "reading_date") -> DataFrame:
    """Distinct entities per range of days and group, from stored sketches: range, keys, approx_distinct.

    ``ranges`` has name, first_day and last_day (both included); a few lines
    (at most ``MAX_RANGES``). A partial union runs in the map tasks: a task sends one
    sketch per range and group, whatever the number of days.
    """
    if ranges.count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges")
    # One line per day of a range: bounded by the ranges and the calendar.
    held = ranges.select(F.col("name").alias("range"), F.explode(F.sequence("first_day", "last_day")).alias(date))
    united = sketches.join(held, date).groupBy("range", *keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select("range", *keys, F.hll_sketch_estimate("sketch").alias("approx_distinct"))


# Ranks at which a sketch is asked for a bracket, its size, and how many ranks a bracket is wide on each side.
GRID, SKETCH_K, MARGIN = 1_024, 8_192, 2
# Rounds of bracketing; each leaves about (2 * MARGIN + 1) / GRID of the rows.
ROUNDS = 2


def _bracket(rank: Column, n: Column, grid: str) -> list[Column]:
    """Values of the sketch's grid around a rank out of ``n``."""
    at = rank.cast("double") / n * F.lit(float(GRID))
    lowest = F.least(F.lit(GRID), F.greatest(F.lit(0), F.floor(at).cast("int") - MARGIN))
    highest = F.least(F.lit(GRID), F.ceil(at).cast("int") + MARGIN)
    return [F.element_at(grid, lowest + 1).alias("_lo"), F.element_at(grid, highest + 1).alias("_hi")]


def _grid(x: str) -> Column:
    """Values at evenly spaced ranks of a group, from a mergeable sketch."""
    ranks = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    return F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, F.lit(SKETCH_K)), ranks)


def _narrowed(tagged: DataFrame, at: Sequence[str]) -> DataFrame:
    """Rows tagged with their group's rank and bracket -> the rows of the part (below, in or above it) that holds the rank.

    The parts are counted exactly, so the rank is never lost, however good the
    sketch: a bracket that misses only leaves more rows.
    """
    x, rank = F.col("_x"), F.col("_rank")
    parts = tagged.groupBy(*at).agg(
        F.first("_rank").alias("_rank"), F.count_if(x < F.col("_lo")).alias("_below"), F.count_if(x <= F.col("_hi")).alias("_upto"), F.count(F.lit(1)).alias("_n"))
    part = F.when(rank <= F.col("_below"), 0).when(rank <= F.col("_upto"), 1).otherwise(2)
    left = F.when(rank <= F.col("_below"), F.lit(0)).when(rank <= F.col("_upto"), F.col("_below")).otherwise(F.col("_upto"))
    chosen = parts.select(*at, part.alias("_part"), (rank - left).alias("_left"))
    mine = F.when(x < F.col("_lo"), 0).when(x <= F.col("_hi"), 1).otherwise(2)
    held = keyed_join(tagged.drop("_rank"), chosen, at).where(mine == F.col("_part"))
    return held.select(*at, "_value", "_x", F.col("_left").alias("_rank"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], rounds: int | None = None) -> DataFrame:
    """Exact discrete quantiles per key, without sorting a key's rows in one task.

    For each ``name: p`` the result is the value at rank ceil(p * n) (1-based,
    ascending, NULLs ignored, NaN above all numbers; the rank in exact decimal
    arithmetic), i.e. the smallest value with at least p * n values at or below
    it.

    1. A mergeable (KLL) sketch per key gives values at evenly spaced ranks; two
       of them bracket each rank.
    2. The rows below, in and above each bracket are counted, and those of the
       part that holds the rank go on, with the rank that is left.
    3. This is done ``rounds`` times, from the second on with a sketch per key
       and quantile over the rows that are left. Brackets follow ranks, not
       values, so it makes no difference how values crowd or repeat.
    4. What remains, about n / 200 ** rounds rows, is collapsed to (value, count)
       pairs, and a running count finds the value.

    The brackets, and between rounds the rows that go on, are checkpointed
    (reliably, in the shared folder): a sketch depends on chance, so one that is
    computed again is another one. A NULL key is a group like any other.
    """
    import decimal

    keys, names = list(keys), list(probs)
    rounds = ROUNDS if rounds is None else rounds
    ensure_checkpoint_dir(df.sparkSession)
    src = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), F.col(value).cast("double").alias("_x"))
    is_nan = F.isnan("_x")
    numbers = src.where(~is_nan)
    sketched = numbers.groupBy(*keys).agg(*([_grid("_x").alias("_grid")] if rounds else [F.lit(None).alias("_grid")]))
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.count_if(~is_nan).alias("_n"), F.max(F.when(is_nan, F.col("_value"))).alias("_nan"))
    at = [*keys, "_i"]
    wanted = F.array(*[
        F.struct(F.lit(i).alias("_i"), F.greatest(F.lit(1), F.ceil(F.lit(decimal.Decimal(repr(float(probs[nm])))) * F.col("_all"))).cast("long").alias("_rank"))
        for i, nm in enumerate(names)])
    targets = counts.select(*keys, "_n", "_nan", F.explode(wanted).alias("_t")).select(*keys, "_n", "_nan", "_t.*")
    # One line per key, with all of its brackets, meets the rows; only rows of a rank's part are repeated for it.
    # A rank among the NaN finds no number below; it is answered at the end.
    goals = keyed_join(targets, sketched, keys)
    if rounds:
        # A sketch computed anew would differ; the brackets, one line per key and quantile, must not.
        goals = goals.select(*at, "_rank", *_bracket(F.col("_rank"), F.col("_n"), "_grid")).checkpoint()
        lined = goals.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_rank", "_lo", "_hi"))).alias("_goals"))
        met = keyed_join(numbers, lined, keys)
        x = F.col("_x")
        seen = [F.col("_goals")[i] for i in range(len(names))]
        tally = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_below{i}").alias("_below"), F.col(f"_upto{i}").alias("_upto")) for i in range(len(names))])
        parts = met.groupBy(*keys).agg(*[F.count_if(x < g["_lo"]).alias(f"_below{i}") for i, g in enumerate(seen)],
                                       *[F.count_if(x <= g["_hi"]).alias(f"_upto{i}") for i, g in enumerate(seen)])
        parts = parts.select(*keys, F.explode(tally).alias("_p")).select(*keys, "_p.*")
        rank = F.col("_rank")
        chosen = keyed_join(goals, parts, at).select(
            *at, "_lo", "_hi",
            F.when(rank <= F.col("_below"), 0).when(rank <= F.col("_upto"), 1).otherwise(2).alias("_part"),
            (rank - F.when(rank <= F.col("_below"), F.lit(0)).when(rank <= F.col("_upto"), F.col("_below")).otherwise(F.col("_upto"))).alias("_left"))
        picks = chosen.groupBy(*keys).agg(F.collect_list(F.struct("_i", "_left", "_lo", "_hi", "_part")).alias("_picks"))
        part_of = lambda g: F.when(x < g["_lo"], 0).when(x <= g["_hi"], 1).otherwise(2)
        going = keyed_join(numbers, picks, keys).select(
            *keys, "_value", "_x", F.explode(F.filter("_picks", lambda g: part_of(g) == g["_part"])).alias("_g"))
        band = going.select(*keys, F.col("_g._i").alias("_i"), "_value", "_x", F.col("_g._left").alias("_rank"))
    else:
        band = keyed_join(numbers, goals.groupBy(*keys).agg(F.collect_list(F.struct("_i", "_rank")).alias("_goals")), keys) \
            .select(*keys, "_value", "_x", F.explode("_goals").alias("_g")).select(*keys, F.col("_g._i").alias("_i"), "_value", "_x", F.col("_g._rank").alias("_rank"))
    for _ in range(1, rounds):
        band = band.checkpoint()
        inner = band.groupBy(*at).agg(_grid("_x").alias("_grid"), F.count(F.lit(1)).alias("_n"), F.first("_rank").alias("_r"))
        brackets = inner.select(*at, *_bracket(F.col("_r"), F.col("_n"), "_grid")).checkpoint()
        band = _narrowed(keyed_join(band, brackets, at), at)
    pairs = band.groupBy(*at, "_value").agg(F.count(F.lit(1)).alias("_c"), F.first("_rank").alias("_rank"))
    walk = Window.partitionBy(*at).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    hit = pairs.withColumn("_cum", F.sum("_c").over(walk)).where(F.col("_cum") >= F.col("_rank")).groupBy(*at).agg(F.min("_value").alias("_q"))
    over = targets.where(F.col("_rank") > F.col("_n")).select(*at, F.col("_nan").alias("_q"))
    wide = hit.unionByName(over).groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(nm) for i, nm in enumerate(names)])
    return keyed_join(counts.select(*keys), wide, keys, "left")
