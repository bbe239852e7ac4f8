"""All sensor checks in one pass (K1-K6, K9).

The single checks of :mod:`tidemark.operators.checks` each read their input
anew.  Here a table of measures says what every check needs of the rows; they
are compiled into one aggregate per (sensor, parameter, location, day), and
what the checks need of coarser grains is aggregated from those cells:

    rows -> cells (one aggregate: every rule of rows, moments, ranks)
         -> window over a series' days (the rolling mean, K5)
         -> one grouping-sets aggregate: per (location, parameter) for K1-K3,
            K5, K9, per sensor for K6
         -> beside the stored summary by union and aggregate (K2)

A second aggregate over the rows counts each series' distinct positions (K4 and
the key of K9).  So the features are read twice, however many checks there are,
and no row is joined or shuffled beyond these two aggregates' partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import dec, mean_from, measure, percent, round3, sd_from
from tidemark.operators.checks import DISTINCT_BAND, REQUIRED, SUMMARY_QUANTILES, differs, feature_rules, rank_off
from tidemark.operators.joins import keyed_join
from tidemark.operators.series import day_number
from tidemark.sources.schemas import LOCATION_STATS, READINGS_FEATURES

SERIES = ("sensor_id", "parameter")
GROUP = ("location", "parameter")
#: Verdicts in the order in which the checks are known.
CHECKS = ("arrival", "summary_agrees", "window_consistent", "positions_complete", "rolling_mean_recomputes",
          "one_location_per_sensor", "readings_constraints", "location_stats_constraints")

# Measures of the summary that agree within the tolerance, and those that are equal.
CLOSE = ("avg_value", "stddev_value", "min_value", "max_value", "bad_pct")
EQUAL = ("readings", "first_reading", "last_reading")


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _broken(conditions: Sequence[Column]) -> Column:
    """How many of the conditions hold for a row."""
    out = F.lit(0)
    for c in conditions:
        out = out + F.when(c, 1).otherwise(0)
    return out


def row_measures(value: str = "value", decimals: int = 3) -> list[Column]:
    """What the checks need of the rows, as aggregates of a cell."""
    x, stored, v = dec(value, measure(decimals)), F.col("rolling_avg_7d"), F.col(value)
    ranks = [
        F.count_if(v < F.col(f"_q_{c}") if below else v <= F.col(f"_q_{c}")).alias(f"_{name}_{c}")
        for c, _ in SUMMARY_QUANTILES for name, below in (("lt", True), ("le", False))
    ]
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_any([F.col(c).isNull() for c in REQUIRED])).alias("incomplete"),
        F.sum(_broken(list(feature_rules(value).values()))).alias("window_broken"),
        F.sum(_broken([~r.holds for r in READINGS_FEATURES.rules()])).alias("row_broken"),
        F.count(x).alias("n"), F.sum(x).alias("s1"), F.sum(x * x).alias("s2"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.count_if(F.col("status") == "Bad").alias("bad"),
        F.min(stored).alias("stored_low"), F.max(stored).alias("stored_high"), F.count_if(stored.isNull()).alias("stored_nulls"),
        *ranks,
    ]


def rolling_off(days: int) -> Column:
    """Rows of a cell whose stored rolling mean is not that of its series' last ``days`` days."""
    frame = Window.partitionBy(*SERIES).orderBy(day_number("reading_date")).rangeBetween(-(days - 1), 0)
    expected = round3(mean_from(F.sum("n").over(frame), F.sum("s1").over(frame)))
    off = ((F.col("stored_nulls") > 0) & expected.isNotNull()) | differs(F.col("stored_low"), expected) | differs(F.col("stored_high"), expected)
    return F.when(off, F.col("rows")).otherwise(0)


def grains(cells: DataFrame) -> DataFrame:
    """The cells per (location, parameter), with its distinct sensors, and per sensor, with the least and largest of its locations."""
    ranks = [f"_{name}_{c}" for c, _ in SUMMARY_QUANTILES for name in ("lt", "le")]
    summed = ["rows", "incomplete", "window_broken", "row_broken", "rolling_broken", "n", "s1", "s2", "bad", *ranks]
    shown = cells.withColumns({"_sensor": F.col("sensor_id"), "_place": F.col("location")})
    return shown.groupingSets([[F.col(c) for c in GROUP], [F.col("sensor_id")]], *GROUP, "sensor_id").agg(
        F.grouping("sensor_id").alias("of_group"),
        *[F.sum(c).alias(c) for c in summed],
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.min("reading_date").alias("first_reading"), F.max("reading_date").alias("last_reading"),
        F.count_distinct("_sensor").alias("sensors"),
        (F.min("_place") != F.max("_place")).alias("moved"),
    )


def _lines(frame: DataFrame, **violations: tuple[Column, Column]) -> DataFrame:
    """(check_id, rows_checked, violations) from one aggregate over ``frame``; NULL sums count as 0."""
    zero = F.lit(0).cast("long")
    wide = frame.agg(*[F.coalesce(c.cast("long"), zero).alias(f"{name}_{k}") for name, pair in violations.items() for k, c in enumerate(pair)])
    lines = F.array(*[
        F.struct(F.lit(name).alias("check_id"), F.col(f"{name}_0").alias("rows_checked"), F.col(f"{name}_1").alias("violations")) for name in violations])
    return wide.select(F.explode(lines).alias("line")).select("line.*")


def sensor_suite(features: DataFrame, summary: DataFrame, expected_categories: int = 6, days: int = 7, decimals: int = 3) -> DataFrame:
    """One verdict row per check of :data:`CHECKS` over the series features and the stored location profile.

    Verdicts and counts are those of the single checks. ``summary`` is read
    three times (its quantiles, its measures, its constraints): pass a written
    table, or one that is cheap to compute.
    """
    # One line per key, so that a summary that repeats one does not multiply rows.
    quantiles = summary.groupBy(*GROUP).agg(*[F.max(c).alias(f"_q_{c}") for c, _ in SUMMARY_QUANTILES])
    seen = keyed_join(features, quantiles, GROUP, "left")
    cells = seen.groupBy(*SERIES, "location", "reading_date").agg(*row_measures(decimals=decimals))
    coarse = grains(cells.withColumn("rolling_broken", rolling_off(days)))

    off = _any([rank_off(c, p) for c, p in SUMMARY_QUANTILES])
    again = coarse.withColumns({
        "readings": F.when(F.col("of_group") == 1, F.col("rows")),
        "avg_value": mean_from(F.col("n"), F.col("s1")),
        "stddev_value": sd_from(F.col("n"), F.col("s1"), F.col("s2")),
        "bad_pct": percent(F.col("bad"), F.col("rows")),
    }).withColumn("quantile_off", off)
    measures = [*CLOSE, *EQUAL, "sensors"]
    told = again.select(
        "of_group", *GROUP, "sensor_id", F.lit(1).alias("in_rows"), F.lit(0).alias("in_summary"), "rows", "incomplete", "window_broken",
        "row_broken", "rolling_broken", "moved", "quantile_off", *[F.col(c).alias(f"_r_{c}") for c in measures])
    stored = summary.select(
        F.lit(1).cast("tinyint").alias("of_group"), *GROUP, F.lit(None).cast("string").alias("sensor_id"), F.lit(0).alias("in_rows"),
        F.lit(1).alias("in_summary"), *[F.col(c).alias(f"_s_{c}") for c in measures])
    # A full outer join by union: each side has its columns, the other's are NULL.
    both = told.unionByName(stored, allowMissingColumns=True)
    keys = ["of_group", *GROUP, "sensor_id"]
    paired = both.groupBy(*keys).agg(
        F.sum("in_rows").alias("in_rows"), F.sum("in_summary").alias("in_summary"),
        *[F.max(c).alias(c) for c in both.columns if c not in (*keys, "in_rows", "in_summary")])
    wrong = (F.col("in_rows") != 1) | (F.col("in_summary") != 1) | F.col("quantile_off")
    for c in CLOSE:
        wrong = wrong | differs(F.col(f"_s_{c}"), F.col(f"_r_{c}"))
    for c in EQUAL:
        wrong = wrong | ~F.col(f"_s_{c}").eqNullSafe(F.col(f"_r_{c}"))
    band = F.greatest(F.lit(1.0), F.col("_r_sensors") * F.lit(DISTINCT_BAND))
    wrong = wrong | (F.abs(F.col("_s_sensors") - F.col("_r_sensors")) > band)

    group, sensor = F.col("of_group") == 1, F.col("of_group") == 0
    of_rows = lambda c: F.sum(F.when(group, F.col(c)))
    arrived = F.coalesce(of_rows("rows"), F.lit(0))
    categories = F.count_distinct(F.when(group & (F.col("in_rows") > 0), F.col("parameter")))
    by_rows = _lines(
        paired,
        arrival=(arrived, F.coalesce(of_rows("incomplete"), F.lit(0)) + F.when(arrived == 0, 1).otherwise(0) + F.when(categories != expected_categories, 1).otherwise(0)),
        summary_agrees=(F.sum("in_summary"), F.count_if(group & F.coalesce(wrong, F.lit(True)))),
        window_consistent=(arrived, of_rows("window_broken")),
        rolling_mean_recomputes=(arrived, of_rows("rolling_broken")),
        one_location_per_sensor=(F.count_if(sensor), F.count_if(sensor & F.col("moved"))),
        readings_constraints=(arrived, of_rows("row_broken")),
    )

    place = F.col("reading_no")
    series = features.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"), F.count(place).alias("set"), F.count_distinct(place).alias("d"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    unset = F.when(F.col("sensor_id").isNull() | F.col("parameter").isNull(), F.col("n")).otherwise(F.col("n") - F.col("set"))
    repeats = F.col("n") - F.col("d") - F.when(F.col("set") < F.col("n"), 1).otherwise(0)
    by_series = _lines(
        series,
        positions_complete=(F.count(F.lit(1)), F.count_if((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n")))),
        readings_constraints=(F.lit(0), F.sum(unset + repeats)),
    )

    per_key = summary.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.sum(_broken([~r.holds for r in LOCATION_STATS.rules()])).alias("broken"))
    keyless = F.when(F.col("location").isNull() | F.col("parameter").isNull(), F.col("n")).otherwise(0)
    by_summary = _lines(per_key, location_stats_constraints=(F.sum("n"), F.sum(F.col("broken") + F.col("n") - 1 + keyless)))

    lines = by_rows.unionByName(by_series).unionByName(by_summary)
    found = lines.groupBy("check_id").agg(F.max("rows_checked").alias("rows_checked"), F.sum("violations").alias("violations"))
    return found.withColumn("verdict", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
