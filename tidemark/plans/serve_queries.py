"""Registered serving queries (what the API would answer) and their SQL twins.

Per-entity queries pick their sensor inside the plan (the smallest id, as a
scalar subquery), so they run over the whole tables without a driver round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profile, serve, series
from tidemark.plans.catalog import register
from tidemark.plans.sensor_queries import LOCATION_PROFILE_SQL, PARAMETERS, SERIES_FEATURES, features
from tidemark.plans.sql_fixtures import BROKEN_READINGS, READINGS, with_
from tidemark.functions.numeric import sql_percent, sql_round, sql_sd
from tidemark.sources import fixtures

READING_COLS = ", ".join(serve.READING_COLUMNS)
FIRST_SENSOR_SQL = "(SELECT min(sensor_id) FROM readings)"

# The request parameters the registered queries exercise.
SEARCH_FRAGMENT, SEARCH_LIMIT = "12", 20
PROBE_PARAMETER, PROBE_STATUS = "error", "Bad"
PAGE_SORT, PAGE_ORDER, PAGE_LIMIT, PAGE_OFFSET = "z_score", "desc", 50, 5
FILTER_PARAMETER = "click"
GLOBAL_SORT, GLOBAL_ORDER, GLOBAL_LIMIT, GLOBAL_OFFSET = "delta", "asc", 100, 50
CHOSEN_LOCATION = "EUROPE"


def _readings(spark, sf_dir):
    return fixtures.readings(spark, sf_dir)


def _first_sensor(df):
    return df.select(F.min("sensor_id")).scalar()


# --- G1 / F4 / E11 -------------------------------------------------------------------

@register("sensor_ids", with_(READINGS) + "SELECT DISTINCT sensor_id FROM readings")
def sensor_ids(spark, sf_dir):
    return serve.distinct_ids(_readings(spark, sf_dir))


SEARCH_SQL = with_(READINGS) + f"""
SELECT sensor_id, count(*) OVER () AS total
FROM (SELECT DISTINCT sensor_id FROM readings WHERE sensor_id LIKE '%{SEARCH_FRAGMENT}%')
ORDER BY sensor_id LIMIT {SEARCH_LIMIT}
"""


@register("search_ids", SEARCH_SQL)
def search_ids(spark, sf_dir):
    return serve.search_ids(_readings(spark, sf_dir), SEARCH_FRAGMENT, SEARCH_LIMIT)


@register("search_envelope")
def search_envelope(spark, sf_dir):
    return serve.search_envelope(_readings(spark, sf_dir), SEARCH_FRAGMENT, SEARCH_LIMIT)


# --- D3 ----------------------------------------------------------------------------------

# A sensor's rows as lists; the measures come from list functions.
HELD = """held AS (
    SELECT sensor_id, list(location) AS places, list_sort(list(reading_date)) AS days, list_filter(list(status), lambda x: x = 'Bad') AS bad
    FROM readings GROUP BY sensor_id)"""
SUMMARY_COLS = f"""list_min(places) AS location, len(places) AS readings, days[1] AS first_reading, days[-1] AS last_reading,
       len(bad) AS bad_readings, {sql_round("CAST(100 * len(bad) AS DOUBLE) / CAST(len(places) AS DOUBLE)")} AS bad_pct"""


@register("sensor_summary", with_(READINGS, HELD) + f"SELECT {SUMMARY_COLS} FROM held WHERE sensor_id = {FIRST_SENSOR_SQL}")
def sensor_summary(spark, sf_dir):
    r = _readings(spark, sf_dir)
    return serve.entity_summary(r, entity=_first_sensor(r))


@register("sensor_summaries", with_(READINGS, HELD) + f"SELECT sensor_id, {SUMMARY_COLS} FROM held")
def sensor_summaries(spark, sf_dir):
    return serve.entity_summary(_readings(spark, sf_dir))


# --- D4 ----------------------------------------------------------------------------------

HELD_BY_PARAMETER = """cells AS (
    SELECT sensor_id, parameter, list(value) AS v, list(CAST(value AS DECIMAL(18,3))) AS x, list_sort(list(reading_date)) AS days,
           list_filter(list(status), lambda s: s = 'Bad') AS bad
    FROM readings GROUP BY sensor_id, parameter),
sums AS (
    SELECT *, len(v) AS n, list_sum(x) AS s1, list_sum(list_transform(x, lambda y: y * y)) AS s2 FROM cells)"""
PARAM_COLS = f"""n AS readings, {sql_round("CAST(s1 AS DOUBLE) / n")} AS avg_value,
       {sql_round('list_min(v)')} AS min_value, {sql_round('list_max(v)')} AS max_value,
       {sql_round("CASE WHEN n > 1 THEN sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) END")} AS stddev_value,
       len(bad) AS bad_readings, {sql_round("CAST(100 * len(bad) AS DOUBLE) / CAST(n AS DOUBLE)")} AS bad_pct,
       days[1] AS first_reading, days[-1] AS last_reading"""


@register("sensor_parameter_summary", with_(READINGS, HELD_BY_PARAMETER) + f"""
SELECT parameter, {PARAM_COLS} FROM sums WHERE sensor_id = {FIRST_SENSOR_SQL}""")
def sensor_parameter_summary(spark, sf_dir):
    r = _readings(spark, sf_dir)
    return serve.parameter_summary(r, entity=_first_sensor(r))


@register("sensor_parameter_summaries", with_(READINGS, HELD_BY_PARAMETER) + f"""
SELECT sensor_id, parameter, {PARAM_COLS} FROM sums""")
def sensor_parameter_summaries(spark, sf_dir):
    return serve.parameter_summary(_readings(spark, sf_dir))


# --- D9 (nested; rows-only) -------------------------------------------------------------

@register("sensor_documents")
def sensor_documents(spark, sf_dir):
    return serve.entity_documents(_readings(spark, sf_dir))


# --- D10 / C2 ------------------------------------------------------------------------------

HEALTH_SQL = with_(READINGS, SERIES_FEATURES, f"location_stats AS ({LOCATION_PROFILE_SQL[len(with_(READINGS)):]})") + """
SELECT CASE WHEN (SELECT count(*) FROM features) > 0 THEN 'ok' ELSE 'empty' END AS status,
       (SELECT count(*) FROM features) AS readings,
       (SELECT count(*) FROM location_stats) AS summaries
"""


@register("table_health", HEALTH_SQL)
def table_health(spark, sf_dir):
    return serve.table_health(features(spark, sf_dir), profile.group_profile(_readings(spark, sf_dir)))


# --- C5 ----------------------------------------------------------------------------------------

PROBE_SQL = with_(READINGS) + f"""
SELECT count(*) AS exists_rows,
       count(*) FILTER (WHERE parameter = '{PROBE_PARAMETER}' AND status = '{PROBE_STATUS}') AS matching_rows
FROM readings WHERE sensor_id = {FIRST_SENSOR_SQL}
"""


@register("existence_probe", PROBE_SQL)
def existence_probe(spark, sf_dir):
    r = _readings(spark, sf_dir)
    cond = (F.col("parameter") == PROBE_PARAMETER) & (F.col("status") == PROBE_STATUS)
    return serve.existence_probe(r, _first_sensor(r), cond)


# --- F2 / F3 ----------------------------------------------------------------------------------

PAGE_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS} FROM features WHERE sensor_id = {FIRST_SENSOR_SQL}
ORDER BY {PAGE_SORT} DESC NULLS FIRST, parameter, reading_no
LIMIT {PAGE_LIMIT} OFFSET {PAGE_OFFSET}
"""


def _entity_features(spark, sf_dir):
    """Features of the chosen sensor only: a series depends on its own rows alone,
    so the filter goes first and even the hot-series count reads one sensor."""
    r = _readings(spark, sf_dir)
    sensor = _first_sensor(r)
    return series.series_features(serve.for_entity(r, sensor)), sensor


@register("readings_page", PAGE_SQL)
def readings_page(spark, sf_dir):
    f, sensor = _entity_features(spark, sf_dir)
    return serve.page(f, sensor, sort=PAGE_SORT, order=PAGE_ORDER, limit=PAGE_LIMIT, offset=PAGE_OFFSET)


PAGE_FILTERED_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS} FROM features
WHERE sensor_id = {FIRST_SENSOR_SQL} AND parameter = '{FILTER_PARAMETER}'
ORDER BY value ASC NULLS LAST, parameter, reading_no
LIMIT 20
"""


@register("readings_page_filtered", PAGE_FILTERED_SQL)
def readings_page_filtered(spark, sf_dir):
    f, sensor = _entity_features(spark, sf_dir)
    return serve.page(f, sensor, parameter=FILTER_PARAMETER, sort="value", order="asc", limit=20)


PAGE_GLOBAL_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS} FROM features
ORDER BY {GLOBAL_SORT} ASC NULLS LAST, sensor_id, parameter, reading_no
LIMIT {GLOBAL_LIMIT} OFFSET {GLOBAL_OFFSET}
"""


@register("readings_page_all_sensors", PAGE_GLOBAL_SQL)
def readings_page_all_sensors(spark, sf_dir):
    return serve.page(features(spark, sf_dir), None, sort=GLOBAL_SORT, order=GLOBAL_ORDER,
                      limit=GLOBAL_LIMIT, offset=GLOBAL_OFFSET)


ENVELOPE_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT count(*) AS total, {PAGE_LIMIT} AS "limit", {PAGE_OFFSET} AS "offset",
       '{PAGE_SORT}' AS sort, '{PAGE_ORDER}' AS "order", count(*) > {PAGE_LIMIT + PAGE_OFFSET} AS has_more
FROM features WHERE sensor_id = {FIRST_SENSOR_SQL}
"""


@register("page_envelope", ENVELOPE_SQL)
def page_envelope(spark, sf_dir):
    f, sensor = _entity_features(spark, sf_dir)
    return serve.page_envelope(f, sensor, sort=PAGE_SORT, order=PAGE_ORDER, limit=PAGE_LIMIT, offset=PAGE_OFFSET)


# --- B7 / B12 / B13 / B14 / B15 / F6 -----------------------------------------------------------

@register("optional_filters", with_(READINGS) + f"SELECT * FROM readings WHERE parameter = '{FILTER_PARAMETER}'")
def optional_filters(spark, sf_dir):
    return serve.optional_filters(_readings(spark, sf_dir), parameter=FILTER_PARAMETER, status=None)


FLAGS_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS}, coalesce(abs(z_score) > 2.0, false) AS is_outlier FROM features
"""


@register("reading_flags", FLAGS_SQL)
def reading_flags(spark, sf_dir):
    return serve.flag_outliers(serve.reading_rows(features(spark, sf_dir)))


VALIDATION_SQL = with_(READINGS) + f"""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce(regexp_full_match(sensor_id, '[0-9a-z]{{7}}'), false)) AS bad_id,
       count(*) FILTER (WHERE NOT coalesce(parameter IN ({", ".join(f"'{p}'" for p in PARAMETERS)}), false)) AS bad_parameter,
       count(*) FILTER (WHERE NOT coalesce(status IN ('Good', 'Bad'), false)) AS bad_status
FROM readings
"""


@register("row_validation", VALIDATION_SQL)
def row_validation(spark, sf_dir):
    return serve.validate_rows(_readings(spark, sf_dir), PARAMETERS)


@register("location_choices", with_(READINGS) + "SELECT DISTINCT location FROM readings")
def location_choices(spark, sf_dir):
    return serve.choices(_readings(spark, sf_dir), "location")


@register("location_table", LOCATION_PROFILE_SQL + "ORDER BY location, parameter")
def location_table(spark, sf_dir):
    return serve.ordered_table(profile.group_profile(_readings(spark, sf_dir)))


@register("location_filter", f"SELECT * FROM ({LOCATION_PROFILE_SQL}) WHERE location = '{CHOSEN_LOCATION}'")
def location_filter(spark, sf_dir):
    return serve.optional_filters(profile.group_profile(_readings(spark, sf_dir)), location=CHOSEN_LOCATION)


@register("reading_projection", with_(READINGS, SERIES_FEATURES) + f"SELECT {READING_COLS} FROM features")
def reading_projection(spark, sf_dir):
    return serve.reading_rows(features(spark, sf_dir))


@register("sensor_warnings", with_(READINGS, HELD) + f"""
SELECT sensor_id, {SUMMARY_COLS}, len(bad) > 0 AS warn FROM held""")
def sensor_warnings(spark, sf_dir):
    return serve.flag_warnings(serve.entity_summary(_readings(spark, sf_dir)))


@register("preview_readings", with_(READINGS) + "SELECT * FROM readings ORDER BY seq LIMIT 5")
def preview_readings(spark, sf_dir):
    """A look at the first rows by arrival."""
    from tidemark.sources import io
    return io.preview(_readings(spark, sf_dir), 5, ["seq"])


@register("sensor_document_lines", with_(READINGS, HELD, HELD_BY_PARAMETER) + f"""
SELECT c.*, h.* EXCLUDE (sensor_id) FROM (SELECT sensor_id, parameter, {PARAM_COLS} FROM sums) c
JOIN (SELECT sensor_id, len(places) AS sensor_readings, len(bad) AS sensor_bad FROM held) h USING (sensor_id)""")
def sensor_document_lines(spark, sf_dir):
    """The nested documents (D9) laid out one line per parameter."""
    docs = serve.entity_documents(_readings(spark, sf_dir))
    return docs.select(
        "sensor_id", F.col("readings").alias("sensor_readings"), F.col("bad_readings").alias("sensor_bad"), F.explode("parameters").alias("p")
    ).select("sensor_id", "p.*", "sensor_readings", "sensor_bad")


@register("search_envelope_text", with_(READINGS) + f"""
, ids AS (SELECT DISTINCT sensor_id FROM readings WHERE contains(sensor_id, '{SEARCH_FRAGMENT}'))
SELECT (SELECT string_agg(sensor_id, ',' ORDER BY sensor_id) FROM (SELECT * FROM ids ORDER BY sensor_id LIMIT {SEARCH_LIMIT})) AS items,
       (SELECT count(*) FROM ids) AS total, {SEARCH_LIMIT} AS "limit", (SELECT count(*) FROM ids) > {SEARCH_LIMIT} AS truncated""")
def search_envelope_text(spark, sf_dir):
    """The search envelope with its ids as one text."""
    return serve.search_envelope(_readings(spark, sf_dir), SEARCH_FRAGMENT, SEARCH_LIMIT).withColumn("items", F.concat_ws(",", "items"))


@register("readings_page_after", with_(READINGS, SERIES_FEATURES) + f"""
, mine AS (SELECT {READING_COLS}, row_number() OVER (ORDER BY value, parameter, reading_no) AS nth FROM features WHERE sensor_id = {FIRST_SENSOR_SQL})
SELECT {READING_COLS} FROM mine WHERE nth > 10 AND nth <= 30""")
def readings_page_after(spark, sf_dir):
    """The second page by keyset: it starts after the tenth row, whatever its depth."""
    f, sensor = _entity_features(spark, sf_dir)
    tenth = serve.page(f, sensor, sort="value", order="asc", limit=10).orderBy(F.col("value").desc(), F.col("parameter").desc(), F.col("reading_no").desc()).first()
    return serve.page_after(f, sensor, (tenth["value"], tenth["parameter"], tenth["reading_no"]), sort="value", order="asc", limit=20)


@register("row_validation_broken", with_(BROKEN_READINGS) + VALIDATION_SQL[len(with_(READINGS)):].replace("FROM readings", "FROM broken_readings"))
def row_validation_broken(spark, sf_dir):
    """B13 over rows that break every rule."""
    return serve.validate_rows(fixtures.broken_readings(spark, sf_dir), PARAMETERS)


@register("table_counts", with_(READINGS, HELD) + "SELECT (SELECT count(*) FROM readings) AS readings, (SELECT count(*) FROM held) AS sensors")
def table_counts(spark, sf_dir):
    """C2's row counts side by side."""
    from tidemark.operators import checks
    r = _readings(spark, sf_dir)
    return checks.side_by_side_counts(readings=r, sensors=serve.entity_summary(r))
