"""Data-quality checks as operators (inventory K1-K10, C1, C2, A12, E12).

Every check is one aggregation (or a join of two aggregations) that recomputes
something and counts disagreements, returning one row:

    check_id string, rows_checked bigint, violations bigint, verdict string

``verdict`` is PASS exactly when ``violations`` is 0. ``run_checks`` unions
them; ``assert_checks`` collects that small table (one row per check) and
raises when any failed. Nothing else here brings rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import dec, mean_from, measure, round3
from tidemark.operators.joins import KEY, keyed, keyed_join
from tidemark.operators.series import day_number, previous_value
from tidemark.sources.schemas import READINGS_FEATURES, TableType

#: The columns in which an arrived reading holds a value: those of the readings that its features extend.
REQUIRED = tuple(f.name for f in READINGS_FEATURES.fields[:6])

# The tolerance the reference's checks allow (half of the last of
# three decimals kept), compared in exact decimal.
TOLERANCE = 0.0005
COMPARE_DECIMAL = "decimal(38,12)"


def verdict_row(check_id: str, rows_checked: Column, violations: Column) -> list[Column]:
    return [
        F.lit(check_id).alias("check_id"),
        rows_checked.cast("long").alias("rows_checked"),
        violations.cast("long").alias("violations"),
        F.when(violations == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("verdict"),
    ]


def differs(a: Column, b: Column, tol: float = TOLERANCE) -> Column:
    """True when exactly one side is NULL or both are set and |a-b| > tol (in decimal)."""
    gap = F.abs(a.cast(COMPARE_DECIMAL) - b.cast(COMPARE_DECIMAL))
    return (a.isNull() != b.isNull()) | F.coalesce(gap > F.lit(tol), F.lit(False))


def _bad(status: str = "status") -> Column:
    return F.col(status) == "Bad"


# --- K1 --------------------------------------------------------------------------

def check_arrival(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    category: str = "parameter",
    expected_categories: int = 6,
) -> DataFrame:
    """Rows arrived, none has a NULL in a required column, all categories present."""
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    n = F.count(F.lit(1))
    violations = (
        F.count_if(any_null)
        + F.when(n == 0, 1).otherwise(0)
        + F.when(F.count_distinct(category) != expected_categories, 1).otherwise(0)
    )
    return df.agg(*verdict_row("arrival", n, violations))


# --- K2 / C1 ---------------------------------------------------------------------

def side_by_side(summary: DataFrame, recomputed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """FULL OUTER join on the keys (NULL equals NULL): ``_s_`` and ``_r_`` versions of the columns."""
    s, r = (
        keyed(df, keys).select(KEY, F.lit(True).alias(f"_in_{side}"), *[F.col(c).alias(f"_{side}_{c}") for c in columns])
        for side, df in (("s", summary), ("r", recomputed))
    )
    return s.join(r, KEY, "full")


def reconcile(
    summary: DataFrame,
    recomputed: DataFrame,
    keys: Sequence[str],
    count_col: str,
    measures: Sequence[str],
    tol: float = TOLERANCE,
) -> DataFrame:
    """Keys whose summary and recomputation disagree (C1): FULL OUTER on the keys.

    A disagreement is a key on one side only, unequal counts, or a measure that
    differs by more than ``tol`` (NULL on one side only counts as a difference).
    """
    j = side_by_side(summary, recomputed, keys, [count_col, *measures])
    bad = F.col("_in_s").isNull() | F.col("_in_r").isNull() | ~F.col(f"_s_{count_col}").eqNullSafe(F.col(f"_r_{count_col}"))
    for m in measures:
        bad = bad | differs(F.col(f"_s_{m}"), F.col(f"_r_{m}"), tol)
    return j.select(*[F.col(f"{KEY}.{k}").alias(k) for k in keys], F.col("_in_s").isNotNull().alias("in_summary"),
                    F.col("_in_r").isNotNull().alias("in_recomputed"), bad.alias("disagrees"))


def profile_measures(value: str = "value") -> list[Column]:
    """The profile's measures by Spark's own built-in aggregates, for K2."""
    return [
        F.count(F.lit(1)).alias("readings"),
        F.avg(value).alias("avg_value"),
        F.stddev_samp(value).alias("stddev_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        (100.0 * F.avg(_bad().cast("double"))).alias("bad_pct"),
        F.min("reading_date").alias("first_reading"),
        F.max("reading_date").alias("last_reading"),
    ]


# The quantiles the summary reports, the sketch accuracy behind
# them, and the band an HLL count must fall in (3 x its 2% relative error).
SUMMARY_QUANTILES = (("median_value", 0.5), ("p95_value", 0.95))
QUANTILE_ACCURACY = 10_000
DISTINCT_BAND = 0.06


def rank_off(column: str, p: float, accuracy: int = QUANTILE_ACCURACY) -> Column:
    """Whether a reported quantile's rank is outside the sketch's bound.

    Over n values, fewer than p*n + n/accuracy + 1 must be below it and at least
    p*n - n/accuracy - 1 at or below it (ties count on either side).
    """
    slack = F.col("readings") / F.lit(float(accuracy)) + F.lit(1.0)
    goal = F.col("readings") * F.lit(p)
    return (F.col(f"_lt_{column}") > goal + slack) | (F.col(f"_le_{column}") < goal - slack)


def check_summary(summary: DataFrame, readings: DataFrame, keys: Sequence[str] = ("location", "parameter"),
                  entity: str = "sensor_id", value: str = "value") -> DataFrame:
    """The location summary agrees with the readings it summarises (K2).

    Count, mean, sd, min, max and bad % within the tolerance, first and last
    dates equal, median and p95 within the sketch's rank bound, and the sensor
    count within the band of the exact distinct count. The readings are read
    twice (all measures at once, and the distinct sensors); a NULL key is a
    group like any other.
    """
    from tidemark.operators.profile import count_distinct_by

    keys = list(keys)
    close = ["avg_value", "stddev_value", "min_value", "max_value", "bad_pct"]
    equal = ["readings", "first_reading", "last_reading"]
    quantiles = summary.select(*keys, *[F.col(c).alias(f"_q_{c}") for c, _ in SUMMARY_QUANTILES])
    seen = keyed_join(readings, quantiles, keys, "left")
    ranks = [
        F.count_if(F.col(value) < F.col(f"_q_{c}") if below else F.col(value) <= F.col(f"_q_{c}")).alias(f"_{name}_{c}")
        for c, _ in SUMMARY_QUANTILES for name, below in (("lt", True), ("le", False))
    ]
    again = seen.groupBy(*keys).agg(*profile_measures(value), *ranks)
    off = F.lit(False)
    for c, p in SUMMARY_QUANTILES:
        off = off | rank_off(c, p)
    again = again.withColumn("quantile_off", off)
    again = keyed_join(again, count_distinct_by(readings, keys, entity, "sensors"), keys, "left").fillna(0, ["sensors"])
    both = side_by_side(summary.withColumn("quantile_off", F.lit(False)), again, keys, [*close, *equal, "sensors", "quantile_off"])
    wrong = F.col("_in_s").isNull() | F.col("_in_r").isNull()
    for c in close:
        wrong = wrong | differs(F.col(f"_s_{c}"), F.col(f"_r_{c}"))
    for c in equal:
        wrong = wrong | ~F.col(f"_s_{c}").eqNullSafe(F.col(f"_r_{c}"))
    band = F.greatest(F.lit(1.0), F.col("_r_sensors") * F.lit(DISTINCT_BAND))
    wrong = wrong | (F.abs(F.col("_s_sensors") - F.col("_r_sensors")) > band) | F.col("_r_quantile_off")
    return both.agg(*verdict_row("summary_agrees", F.count("_in_s"), F.count_if(F.coalesce(wrong, F.lit(True)))))


# --- K3 / E12 ------------------------------------------------------------------------

def feature_rules(value: str = "value") -> dict[str, Column]:
    """Rule -> rows that break it, for the columns of the series features."""
    change = F.col(value).cast(COMPARE_DECIMAL) - F.col("prev_value").cast(COMPARE_DECIMAL)
    return {
        "delta is value minus prev_value": F.col("prev_value").isNotNull() & differs(F.col("delta"), change),
        "prev_value is set from the second reading on": F.col("prev_value").isNotNull() != (F.col("reading_no") > 1),
        "bad_so_far is at most reading_no": F.col("bad_so_far") > F.col("reading_no"),
    }


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: rule, rows_checked, violations; one aggregation over ``df``."""
    total = F.count(F.lit(1)).alias("rows_checked")
    wide = df.agg(total, *[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"_{k}") for k, broken in enumerate(rules.values())])
    lines = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col("rows_checked"), F.col(f"_{k}").alias("violations")) for k, rule in enumerate(rules)])
    return wide.select(F.explode(lines).alias("line")).select("line.*")


def window_consistency(features: DataFrame, value: str = "value") -> DataFrame:
    """The features' rules with the number of rows that break each."""
    return rule_report(features, feature_rules(value))


def check_window(features: DataFrame) -> DataFrame:
    """K3: every rule of :func:`feature_rules` holds."""
    return window_consistency(features).agg(*verdict_row("window_consistent", F.max("rows_checked"), F.sum("violations")))


# --- K4 / D7 ---------------------------------------------------------------------

def check_positions(features: DataFrame, keys: Sequence[str] = ("sensor_id", "parameter"), position: str = "reading_no") -> DataFrame:
    """K4: positions run 1..n without gaps or repeats in every series."""
    per_series = features.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(position).alias("d"),
        F.min(position).alias("lo"),
        F.max(position).alias("hi"),
    )
    broken = (F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))
    return per_series.agg(*verdict_row("positions_complete", F.count(F.lit(1)), F.count_if(broken)))


# --- K5 ----------------------------------------------------------------------------

def check_rolling(
    features: DataFrame,
    keys: Sequence[str] = ("sensor_id", "parameter"),
    date: str = "reading_date",
    value: str = "value",
    column: str = "rolling_avg_7d",
    days: int = 7,
    decimals: int = 3,
) -> DataFrame:
    """K5: the rolling mean recomputes from raw values within the tolerance.

    Every reading of a day carries that day's mean, so the features reduce to
    one row per (keys, day) in a partial aggregation: rows, the lowest and
    highest stored mean, NULLs among them, and the exact sums that recompute
    it. A RANGE frame over that day table gives the expected mean; a day
    disagrees when its lowest or highest stored value is off (or a NULL is
    present on one side only), and all its rows count as violations. No
    row-level join.
    """
    keys = list(keys)
    x = dec(value, measure(decimals))
    stored = F.col(column)
    per_day = features.groupBy(*keys, date).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(x).alias("_nx"),
        F.sum(x).alias("_s1"),
        F.min(stored).alias("_lo"),
        F.max(stored).alias("_hi"),
        F.count_if(stored.isNull()).alias("_nulls"),
    )
    frame = Window.partitionBy(*keys).orderBy(day_number(date)).rangeBetween(-(days - 1), 0)
    expected = round3(mean_from(F.sum("_nx").over(frame), F.sum("_s1").over(frame)))
    judged = per_day.select("_rows", "_lo", "_hi", "_nulls", expected.alias("_expected"))
    some_null = (F.col("_nulls") > 0) & F.col("_expected").isNotNull()
    off = some_null | differs(F.col("_lo"), F.col("_expected")) | differs(F.col("_hi"), F.col("_expected"))
    return judged.agg(*verdict_row(
        "rolling_mean_recomputes",
        F.sum("_rows"),
        F.coalesce(F.sum(F.when(off, F.col("_rows"))), F.lit(0)),
    ))


# --- K6 / D8 ---------------------------------------------------------------------

def check_one_location(df: DataFrame, entity: str = "sensor_id", attribute: str = "location") -> DataFrame:
    """K6: every entity reports from exactly one location."""
    per = df.groupBy(entity).agg(F.count_distinct(attribute).alias("n"))
    return per.agg(*verdict_row("one_location_per_sensor", F.count(F.lit(1)), F.count_if(F.col("n") > 1)))


# --- K9 / A12 ----------------------------------------------------------------------

def _key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, and rows with a NULL in it."""
    unset = F.lit(False)
    for k in key:
        unset = unset | F.col(k).isNull()
    # A key is in one group, so all of its rows have the NULL or none has.
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1 + F.when(unset, F.col("n")).otherwise(0)), F.lit(0)).alias("violations"))


def check_constraints(df: DataFrame, table: TableType) -> DataFrame:
    """Violation count per constraint of a declared table: constraint, kind, violations.

    One aggregation for all rules of rows, one for the key, which counts the
    rows beyond the first of each key and the rows with a NULL in it.
    """
    rules = table.rules()
    rows = rule_report(df, {r.name: ~r.holds for r in rules})
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.kind)])
    out = rows.select(F.col("rule").alias("constraint"), F.element_at(kinds, F.col("rule")).alias("kind"), "violations")
    named = F.lit(f"key {', '.join(table.key)}").alias("constraint")
    return out.unionByName(_key_violations(df, table.key).select(named, F.lit("primary_key").alias("kind"), "violations"))


def check_table(df: DataFrame, table: TableType, check_id: str) -> DataFrame:
    """K9: all constraints of a table folded into one verdict row."""
    rows = rule_report(df, {r.name: ~r.holds for r in table.rules()})
    key = _key_violations(df, table.key).select(F.lit(0).cast("long").alias("rows_checked"), "violations")
    return rows.select("rows_checked", "violations").unionByName(key).agg(*verdict_row(check_id, F.max("rows_checked"), F.sum("violations")))


# --- K8: bars validation -------------------------------------------------------------

def out_of_order(bars: DataFrame, ticker: str, date: str, arrival: str) -> DataFrame:
    """(ticker, late): rows whose date is before the date of the ticker's previous arrival."""
    with_previous = previous_value(bars.select(ticker, date, arrival), [ticker], arrival, date, out="_before")
    return with_previous.groupBy(ticker).agg(F.count_if(F.coalesce(F.col(date) < F.col("_before"), F.lit(False))).alias("late"))


def validate_bars(
    bars: DataFrame,
    wanted: DataFrame,
    ticker: str = "ticker",
    date: str = "date",
    arrival: str | None = None,
    prices: Sequence[str] = ("open", "high", "low", "close"),
) -> DataFrame:
    """Per wanted ticker, counts of every validation failure (K8).

    Columns: ticker, rows, duplicate_dates, out_of_order, missing_prices,
    nonpositive_prices, unbracketed, failures. ``wanted`` (one column ``ticker``)
    drives a left join so a ticker the repairs emptied still appears, with
    rows = 0 counted as a failure. ``out_of_order`` needs an arrival column:
    a date earlier than the previous arrival's date.
    """
    missing = F.lit(False)
    nonpos = F.lit(False)
    for p in prices:
        missing = missing | F.col(p).isNull() | F.isnan(F.col(p))
        nonpos = nonpos | (F.col(p) <= 0)
    body_hi = F.greatest("open", "close")
    body_lo = F.least("open", "close")
    unbracketed = (F.col("high") < body_hi) | (F.col("low") > body_lo)
    if arrival is not None:
        frame = previous_value(bars, [ticker], arrival, date, out="_prev_date")
        frame = frame.withColumn("_ooo", F.coalesce(F.col(date) < F.col("_prev_date"), F.lit(False)))
    else:
        frame = bars.withColumn("_ooo", F.lit(False))
    per = frame.groupBy(ticker).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(date) - F.count_distinct(date)).alias("duplicate_dates"),
        F.count_if(F.col("_ooo")).alias("out_of_order"),
        F.count_if(missing).alias("missing_prices"),
        F.count_if(F.coalesce(nonpos, F.lit(False))).alias("nonpositive_prices"),
        F.count_if(F.coalesce(unbracketed, F.lit(False))).alias("unbracketed"),
    )
    counts = ["rows", "duplicate_dates", "out_of_order", "missing_prices", "nonpositive_prices", "unbracketed"]
    out = keyed_join(wanted.select(ticker).distinct(), per, [ticker], "left").select(
        ticker, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts]
    )
    failures = (F.col("rows") == 0).cast("long")
    for c in counts[1:]:
        failures = failures + F.col(c)
    return out.withColumn("failures", failures)


def check_bars(validation: DataFrame) -> DataFrame:
    return validation.agg(*verdict_row("bars_valid", F.sum("rows"), F.sum("failures")))


# --- K7 is display_profile in tidemark.operators.profile ------------------------------

# --- union and raise (K10) ------------------------------------------------------------

def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class CheckFailed(AssertionError):
    """Raised for failed checks; ``rows`` has their verdicts."""

    def __init__(self, message: str, rows: Sequence = ()):
        super().__init__(message)
        self.rows = list(rows)


def assert_checks(results: DataFrame) -> list:
    """Collect the verdict table (one row per check) and raise on any FAIL."""
    rows = results.collect()
    failed = [r for r in rows if r["verdict"] != "PASS"]
    if failed:
        detail = "; ".join(f"{r['check_id']}: {r['violations']} of {r['rows_checked']}" for r in failed)
        raise CheckFailed(f"{len(failed)} check(s) failed: {detail}", failed)
    return rows


# --- C2: scalar counts side by side ---------------------------------------------------

def side_by_side_counts(**tables: DataFrame) -> DataFrame:
    """One row with the row count of each named table (C2), as scalar subqueries."""
    (first, df), *others = tables.items()
    counts = [other.select(F.count(F.lit(1))).scalar().alias(name) for name, other in others]
    return df.agg(F.count(F.lit(1)).alias(first)).select(first, *counts)

