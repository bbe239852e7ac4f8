"""Registered queries over written layouts: lookups, deep pages and substring search that read a part of the table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import layouts, serve
from tidemark.plans.catalog import register
from tidemark.plans.sensor_queries import SERIES_FEATURES, features
from tidemark.plans.serve_queries import FIRST_SENSOR_SQL, HELD, READING_COLS, SUMMARY_COLS
from tidemark.plans.sql_fixtures import READINGS, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures


def _path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _clustered(spark, sf_dir) -> tuple[str, str]:
    """(path, id to look up) of the readings by sensor."""
    path = _path(spark, "readings-by-sensor")
    layouts.write_clustered(fixtures.readings(spark, sf_dir), path, ["sensor_id", "parameter", "reading_date", "seq"])
    return path, spark.read.parquet(path).agg(F.min("sensor_id")).first()[0]


@register("sensor_lookup_clustered", with_(READINGS) + f"SELECT * FROM readings WHERE sensor_id = {FIRST_SENSOR_SQL}")
def sensor_lookup_clustered(spark, sf_dir):
    """All readings of a sensor from the clustered table."""
    path, sensor = _clustered(spark, sf_dir)
    return layouts.lookup(spark, path, sensor)


@register("sensor_summary_clustered", with_(READINGS, HELD) + f"SELECT {SUMMARY_COLS} FROM held WHERE sensor_id = {FIRST_SENSOR_SQL}")
def sensor_summary_clustered(spark, sf_dir):
    """A sensor's summary (D3) from the clustered table."""
    path, sensor = _clustered(spark, sf_dir)
    return serve.entity_summary(spark.read.parquet(path), entity=sensor)


# The deep pages.
DEEP_LIMIT, ENTITY_OFFSET, ENTITY_LIMIT, RANGES = 60, 4, 10, 64

DEEP_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS}, rank FROM (
    SELECT *, row_number() OVER (ORDER BY value DESC NULLS FIRST, sensor_id, parameter, reading_no) - 1 AS rank FROM features)
WHERE rank >= (SELECT 9 * count(*) // 10 FROM features) AND rank < (SELECT 9 * count(*) // 10 FROM features) + {DEEP_LIMIT}"""


@register("readings_page_deep", DEEP_SQL)
def readings_page_deep(spark, sf_dir):
    """A page nine tenths down all readings by value (F2): its range is read, not what lies before."""
    table = layouts.RankedTable(spark, _path(spark, "readings-by-value"))
    order = [serve.sort_key("value", "desc"), *[F.col(c).asc() for c in ("sensor_id", "parameter", "reading_no")]]
    table.write(serve.reading_rows(features(spark, sf_dir)), order, RANGES)
    return table.page(9 * table.total() // 10, DEEP_LIMIT)


ENTITY_SQL = with_(READINGS, SERIES_FEATURES) + f"""
SELECT {READING_COLS} FROM features WHERE sensor_id = {FIRST_SENSOR_SQL}
ORDER BY value ASC NULLS LAST, parameter, reading_no LIMIT {ENTITY_LIMIT} OFFSET {ENTITY_OFFSET}"""


@register("readings_page_ranked", ENTITY_SQL)
def readings_page_ranked(spark, sf_dir):
    """A page of one sensor (F2) from a ranked table whose order begins with the sensor."""
    table = layouts.RankedTable(spark, _path(spark, "readings-by-sensor-and-value"))
    order = [F.col("sensor_id").asc(), serve.sort_key("value", "asc"), *[F.col(c).asc() for c in ("parameter", "reading_no")]]
    rows = serve.reading_rows(features(spark, sf_dir))
    table.write(rows, order, RANGES)
    sensor = table.between(0, 1).first()["sensor_id"]
    return table.page(ENTITY_OFFSET, ENTITY_LIMIT, sensor).drop("rank")


# A fragment with grams of its own, and one too short for any.
LONG_FRAGMENT, SHORT_FRAGMENT, FOUND = "0012", "12", 50


def _search_sql(fragment: str) -> str:
    return with_(READINGS) + f"""
, ids AS (SELECT DISTINCT sensor_id FROM readings WHERE contains(sensor_id, '{fragment}'))
SELECT sensor_id, (SELECT count(*) FROM ids) AS total FROM ids ORDER BY sensor_id LIMIT {FOUND}"""


def _index(spark, sf_dir) -> layouts.GramIndex:
    index = layouts.GramIndex(spark, _path(spark, "sensor-grams"))
    index.write(fixtures.readings(spark, sf_dir))
    return index


@register("search_ids_indexed", _search_sql(LONG_FRAGMENT))
def search_ids_indexed(spark, sf_dir):
    """Substring search over the gram index."""
    return _index(spark, sf_dir).search(LONG_FRAGMENT, FOUND)


@register("search_ids_short_fragment", _search_sql(SHORT_FRAGMENT))
def search_ids_short_fragment(spark, sf_dir):
    """A fragment shorter than a gram is looked for in the index's distinct ids."""
    return _index(spark, sf_dir).search(SHORT_FRAGMENT, FOUND)
