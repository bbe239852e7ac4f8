"""Registered queries of guarded writes: broken readings are kept out, sound ones are published."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import guard
from tidemark.operators.series import series_features
from tidemark.plans.catalog import register
from tidemark.plans.sensor_queries import SERIES_FEATURES
from tidemark.plans.sql_fixtures import BROKEN_READINGS, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures
from tidemark.sources.schemas import READINGS_FEATURES

# Fixed value: the share of rows that may go to the quarantine in the second write.
SOME_BAD = 0.5
BROKEN_FEATURES = SERIES_FEATURES.replace("FROM readings", "FROM broken_readings")
_WELL = " AND ".join(f"coalesce({r.sql}, true)" for r in READINGS_FEATURES.rules())


def _written(spark, sf_dir) -> tuple[str, list[guard.GuardedWrite]]:
    """The sound readings, then the broken ones without and with leave to quarantine some."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/guarded-{uuid.uuid4().hex}"
    sound, broken = (series_features(f(spark, sf_dir)) for f in (fixtures.readings, fixtures.broken_readings))
    return base, [guard.guarded_write(sound, base, READINGS_FEATURES), guard.guarded_write(broken, base, READINGS_FEATURES),
                  guard.guarded_write(broken, base, READINGS_FEATURES, max_bad_share=SOME_BAD)]


def _report_sql(version: int, source: str, published: str) -> str:
    return f"""SELECT CAST({version} AS INTEGER) AS version, v."constraint" AS rule, violations, t.rows, t.kept, t.rows - t.kept AS quarantined, {published} AS published
FROM ({READINGS_FEATURES.violations_sql(source)}) v, (SELECT count(*) AS rows, count(*) FILTER (WHERE {_WELL}) AS kept FROM {source}) t
WHERE v.kind <> 'primary_key'"""


REPORT_SQL = with_(BROKEN_READINGS, SERIES_FEATURES.replace("features AS", "sound AS", 1), BROKEN_FEATURES) + "\nUNION ALL\n".join([
    _report_sql(0, "sound", "true"), _report_sql(1, "features", "false"), _report_sql(2, "features", f"t.rows - t.kept <= {SOME_BAD} * t.rows")])


@register("guarded_write_report", REPORT_SQL)
def guarded_write_report(spark, sf_dir):
    """Per write and rule: rows that break it, rows kept and quarantined, and whether the version was published."""
    rows = [(w.version, rule, n, w.rows, w.kept, w.quarantined, w.published) for w in _written(spark, sf_dir)[1] for rule, n in w.violations.items()]
    return spark.createDataFrame(rows, "version int, rule string, violations bigint, rows bigint, kept bigint, quarantined bigint, published boolean")


COLUMNS = [f.name for f in READINGS_FEATURES.fields]


@register("guarded_table", with_(BROKEN_READINGS, BROKEN_FEATURES) + f"SELECT {', '.join(COLUMNS)} FROM features WHERE {_WELL}")
def guarded_table(spark, sf_dir):
    """The published table after the three writes: the sound rows of the last one."""
    return guard.read_published(spark, _written(spark, sf_dir)[0], READINGS_FEATURES)


@register("guarded_quarantine", with_(BROKEN_READINGS, BROKEN_FEATURES) + f"""
SELECT sensor_id, parameter, reading_no, status, array_to_string(list_filter([{', '.join(f"CASE WHEN NOT ({r.sql}) THEN '{r.name}' END" for r in READINGS_FEATURES.rules())}], lambda x: x IS NOT NULL), '; ') AS broken
FROM features WHERE NOT ({_WELL})""")
def guarded_quarantine(spark, sf_dir):
    """The rows that the last write kept out, each with the rules that it breaks."""
    rows = guard.read_quarantine(spark, _written(spark, sf_dir)[0], READINGS_FEATURES, 2)
    return rows.select("sensor_id", "parameter", "reading_no", "status", F.concat_ws("; ", guard.BROKEN).alias("broken"))
