"""Registered queries over the sensor readings (profiles, series, reshape, dates)."""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.sql import functions as F

from tidemark.functions.numeric import sql_mean, sql_percent, sql_round, sql_sd
from tidemark.functions import calendar
from tidemark.operators import profile, reshape, series
from tidemark.plans.catalog import register
from tidemark.plans.sql_fixtures import NULL_READINGS, READINGS, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures, io


def _readings(spark, sf_dir):
    return fixtures.readings(spark, sf_dir)


# --- D1 / C8 / B16: the minimum slice -------------------------------------------

LOCATION_PROFILE_SQL = with_(READINGS) + f"""
SELECT location, parameter,
       count(*)                                   AS readings,
       count(DISTINCT sensor_id)                  AS sensors,
       {sql_round(sql_mean('value'))}             AS avg_value,
       {sql_round(sql_sd('value'))}               AS stddev_value,
       {sql_round('quantile_disc(value, 0.5)')}   AS median_value,
       {sql_round('quantile_disc(value, 0.95)')}  AS p95_value,
       {sql_round('min(value)')}                  AS min_value,
       {sql_round('max(value)')}                  AS max_value,
       {sql_round(sql_percent("count(*) FILTER (WHERE status = 'Bad')", 'count(*)'))} AS bad_pct,
       min(reading_date)                          AS first_reading,
       max(reading_date)                          AS last_reading
FROM readings
GROUP BY location, parameter
"""


@register("location_profile", LOCATION_PROFILE_SQL)
def location_profile(spark, sf_dir):
    return profile.group_profile(_readings(spark, sf_dir))


@register("location_profile_exact_quantiles", LOCATION_PROFILE_SQL)
def location_profile_exact_quantiles(spark, sf_dir):
    """The profile with exact median and p95 (no sketch)."""
    return profile.group_profile(_readings(spark, sf_dir), quantiles="exact")


@register("location_profile_approx_sensors")
def location_profile_approx_sensors(spark, sf_dir):
    """The same profile with the HLL sensor count; rows-only (sketch is engine-specific)."""
    return profile.group_profile(_readings(spark, sf_dir), distinct="approx")


# --- E1-E6: series features ------------------------------------------------------

SERIES_WINDOWS = """
WINDOW w  AS (PARTITION BY sensor_id, parameter ORDER BY reading_date, seq),
       wc AS (PARTITION BY sensor_id, parameter ORDER BY reading_date, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       wr AS (PARTITION BY sensor_id, parameter ORDER BY reading_date
              RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
       wa AS (PARTITION BY sensor_id, parameter)"""

SERIES_COLUMNS = f"""sensor_id, reading_date, location, parameter, value, status, seq,
       CAST(row_number() OVER w AS INTEGER)                               AS reading_no,
       lag(value) OVER w                                                  AS prev_value,
       CAST(CAST(value AS DECIMAL(18,3)) - CAST(lag(value) OVER w AS DECIMAL(18,3)) AS DOUBLE) AS delta,
       {sql_round("CAST(sum(CAST(value AS DECIMAL(18,3))) OVER wr AS DOUBLE) / count(value) OVER wr")} AS rolling_avg_7d,
       CAST(sum(CASE WHEN status = 'Bad' THEN 1 ELSE 0 END) OVER wc AS INTEGER) AS bad_so_far,
       {sql_round("(value - CAST(sum(CAST(value AS DECIMAL(18,3))) OVER wa AS DOUBLE) / count(value) OVER wa) / nullif(" + sql_sd('value', ' OVER wa') + ", 0)")} AS z_score"""

SERIES_FEATURES = f"""features AS (
    SELECT {SERIES_COLUMNS}
    FROM readings
    {SERIES_WINDOWS}
)"""

SERIES_FEATURES_SQL = with_(READINGS, SERIES_FEATURES) + "SELECT * FROM features"


def features(spark, sf_dir):
    return series.series_features(_readings(spark, sf_dir))


@register("series_features", SERIES_FEATURES_SQL)
def series_features_query(spark, sf_dir):
    return features(spark, sf_dir)


# --- G3 / G4: pivot and unpivot ------------------------------------------------

# The parameters the readings fixture carries (events.event_type).
PARAMETERS = ("click", "error", "purchase", "signup", "view")


def _cell_mean_sql(p: str) -> str:
    x = "CAST(value AS DECIMAL(18,3))"
    return sql_round(
        f"CAST(sum({x}) FILTER (WHERE parameter = '{p}') AS DOUBLE)"
        f" / nullif(count({x}) FILTER (WHERE parameter = '{p}'), 0)"
    )


WIDE = "wide AS (\n    SELECT sensor_id, reading_date,\n" + ",\n".join(
    f"           {_cell_mean_sql(p)} AS {p}" for p in PARAMETERS
) + "\n    FROM readings GROUP BY sensor_id, reading_date\n)"

PIVOT_SQL = with_(READINGS, WIDE) + "SELECT * FROM wide"

UNPIVOT_SQL = with_(READINGS, WIDE) + "SELECT * FROM (\n" + "\n    UNION ALL\n".join(
    f"    SELECT sensor_id, reading_date, '{p}' AS parameter, {p} AS value FROM wide" for p in PARAMETERS
) + "\n) WHERE value IS NOT NULL"


def wide(spark, sf_dir):
    return reshape.pivot_mean(_readings(spark, sf_dir), values=PARAMETERS)


@register("pivot_mean", PIVOT_SQL)
def pivot_query(spark, sf_dir):
    return wide(spark, sf_dir)


@register("unpivot_values", UNPIVOT_SQL)
def unpivot_query(spark, sf_dir):
    return reshape.unpivot_values(wide(spark, sf_dir), values=PARAMETERS)


# --- date_parts (§2.8) --------------------------------------------------------------

DATE_PARTS_SQL = with_(READINGS) + """
SELECT sensor_id,
       reading_date                                                   AS date,
       strftime(reading_date, '%Y.%m.%d')                             AS date_label,
       CAST(year(reading_date) AS INTEGER)                            AS year,
       CAST(quarter(reading_date) AS INTEGER)                         AS quarter,
       CAST(month(reading_date) AS INTEGER)                           AS month,
       CAST(weekofyear(reading_date) AS INTEGER)                      AS week,
       CAST(dayofyear(reading_date) AS INTEGER)                       AS day_of_year,
       strftime(reading_date, '%A')                                   AS weekday,
       dayofweek(reading_date) IN (0, 6)                              AS is_weekend,
       CAST(date_trunc('month', reading_date) AS DATE)                AS month_start,
       last_day(reading_date)                                         AS month_end,
       CAST(datediff('day', date_trunc('year', reading_date), reading_date) AS INTEGER) AS days_into_year,
       parameter, value, status
FROM readings
"""


@register("date_parts", DATE_PARTS_SQL)
def date_parts_query(spark, sf_dir):
    return calendar.date_parts(_readings(spark, sf_dir))


# --- NULL keys and the blocked route -------------------------------------------------

NULL_FEATURES = SERIES_FEATURES.replace("FROM readings", "FROM null_readings")
NULL_SERIES_SQL = with_(NULL_READINGS, NULL_FEATURES) + "SELECT * FROM features"

# Small bounds, so that the test tables have hot series and many blocks.
SMALL_HOT, SMALL_BLOCK = 16, 50


@register("series_features_blocked", NULL_SERIES_SQL)
def series_features_blocked(spark, sf_dir):
    """E1-E6 with every series cut into blocks; sensors and parameters may be NULL."""
    return series.series_features(fixtures.readings_with_nulls(spark, sf_dir), hot_rows=0, block_rows=SMALL_BLOCK)


@register("series_features_routed", NULL_SERIES_SQL)
def series_features_routed(spark, sf_dir):
    """E1-E6 with the larger series cut into blocks, the NULL series among them."""
    return series.series_features(fixtures.readings_with_nulls(spark, sf_dir), hot_rows=SMALL_HOT, block_rows=SMALL_BLOCK)


NULL_PROFILE_SQL = with_(NULL_READINGS) + LOCATION_PROFILE_SQL[len(with_(READINGS)):].replace("FROM readings", "FROM null_readings")


@register("profile_null_keys", NULL_PROFILE_SQL)
def profile_null_keys(spark, sf_dir):
    """D1 keeps the groups whose location or parameter is NULL."""
    return profile.group_profile(fixtures.readings_with_nulls(spark, sf_dir))


@register("profile_null_keys_exact_quantiles", NULL_PROFILE_SQL)
def profile_null_keys_exact_quantiles(spark, sf_dir):
    return profile.group_profile(fixtures.readings_with_nulls(spark, sf_dir), quantiles="exact")


@register("previous_value", with_(NULL_READINGS) + """
SELECT seq, sensor_id, value, lag(value) OVER (PARTITION BY sensor_id ORDER BY seq) AS prev FROM null_readings""")
def previous_value(spark, sf_dir):
    """``lag`` by arrival with the hot sensors in blocks; the NULL sensor is one."""
    r = fixtures.readings_with_nulls(spark, sf_dir).select("seq", "sensor_id", "value")
    return series.previous_value(r, ["sensor_id"], "seq", "value", block_rows=SMALL_BLOCK, hot_rows=60)


@register("readings_due", with_(READINGS) + "SELECT seq, CAST(reading_date + INTERVAL 30 DAY AS DATE) AS due FROM readings")
def readings_due(spark, sf_dir):
    """Adding days to a date."""
    from pyspark.sql import functions as F
    return _readings(spark, sf_dir).select("seq", F.date_add("reading_date", 30).alias("due"))


# --- D1b / D5: distinct sensors over time from stored sketches ------------------------------

# Ranges of days, as shares of the readings' span, and the band of the estimate.
SPANS = {"whole": (0.0, 1.0), "first_tenth": (0.0, 0.1), "middle": (0.3, 0.6), "last_week": (0.99, 1.0)}
BAND = 0.02

SKETCHED_SQL = with_(READINGS, f"""spans AS (
    SELECT name, first + CAST(floor(lo * days) AS INTEGER) AS first_day, first + CAST(floor(hi * days) AS INTEGER) AS last_day
    FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, (a, b) in SPANS.items())}) s(name, lo, hi),
         (SELECT min(reading_date) AS first, max(reading_date) - min(reading_date) AS days FROM readings))""") + """
SELECT name AS range, location, count(DISTINCT sensor_id) AS sensors, true AS within_band
FROM readings JOIN spans ON reading_date BETWEEN first_day AND last_day GROUP BY ALL"""


@register("sensors_over_time", SKETCHED_SQL)
def sensors_over_time(spark, sf_dir):
    """Distinct sensors per location in several ranges of days: the exact count, and whether the union of the
    days' stored sketches is within 2 % of it (or within one sensor)."""
    r = _readings(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensor-sketches-{uuid.uuid4().hex}"
    io.write_dataset(profile.daily_sketches(r, ["location"]), path)
    first, days = r.agg(F.min("reading_date"), F.date_diff(F.max("reading_date"), F.min("reading_date"))).first()
    lines = [(n, first + dt.timedelta(days=math.floor(a * days)), first + dt.timedelta(days=math.floor(b * days))) for n, (a, b) in SPANS.items()]
    spans = spark.createDataFrame(lines, "name string, first_day date, last_day date")
    told = profile.distinct_between(io.scan(spark, path), ["location"], spans)
    day_of = spans.select(F.col("name").alias("range"), F.explode(F.sequence("first_day", "last_day")).alias("reading_date"))
    exact = r.join(day_of, "reading_date").groupBy("range", "location").agg(F.count_distinct("sensor_id").alias("sensors"))
    off = F.abs(F.col("approx_distinct") - F.col("sensors"))
    both = exact.join(told, ["range", "location"])
    return both.select("range", "location", "sensors", (off <= F.greatest(F.lit(1.0), F.lit(BAND) * F.col("sensors"))).alias("within_band"))
