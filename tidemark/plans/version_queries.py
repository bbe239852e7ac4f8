"""Registered queries of versioned tables, partial loads and rebuilds by manifest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import bars, versions
from tidemark.operators.versions import VersionedTable
from tidemark.plans import bars_chain
from tidemark.plans.catalog import register
from tidemark.plans.merge_queries import CLASSIFIED, KEY, REPORT_BODY, VALUES
from tidemark.plans.sql_fixtures import ANNOTATED_BARS, UPSERT, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures


def _base(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def with_writer(table: VersionedTable) -> DataFrame:
    """The newest rows of a table, each with the version that wrote it."""
    lines = table.lines().select(F.col(table.group).alias("_g"), "written")
    rows = table.read()
    return rows.join(lines, F.col(table.group).eqNullSafe(F.col("_g"))).drop("_g")


# --- A7: a load that writes only the tickers with news ----------------------------------

LIVELY_SQL = "(" + ", ".join(f"'{t}'" for t in fixtures.LIVELY) + ")"
# The batch repeats the table for tickers without news.
QUIET = f"""news AS (SELECT * FROM incoming WHERE ticker IN {LIVELY_SQL}
    UNION ALL SELECT * FROM target WHERE ticker NOT IN {LIVELY_SQL})"""
QUIET_CLASSIFIED = CLASSIFIED.replace("JOIN incoming i", "JOIN news i")


def _loaded(spark, sf_dir) -> tuple[VersionedTable, dict]:
    """The target as version 0, then the batch loaded."""
    table = VersionedTable(spark, _base(spark, "bars-table"), bars_chain.OHLCV, "ticker", "date")
    table.load(fixtures.upsert_target(spark, sf_dir), KEY, VALUES)
    return table, table.load(fixtures.quiet_incoming(spark, sf_dir), KEY, VALUES)


@register("upsert_partial_snapshot", with_(UPSERT, QUIET, QUIET_CLASSIFIED) + f"""
SELECT date, ticker, {', '.join(VALUES)}, CAST(CASE WHEN ticker IN {LIVELY_SQL} THEN 1 ELSE 0 END AS INTEGER) AS written
FROM classified""")
def upsert_partial_snapshot(spark, sf_dir):
    """The table after a batch with news of two tickers: only their rows were written again."""
    return with_writer(_loaded(spark, sf_dir)[0])


@register("upsert_partial_report", with_(UPSERT, QUIET, QUIET_CLASSIFIED) + REPORT_BODY.replace(
    "SELECT", "SELECT CAST(1 AS INTEGER) AS version, (SELECT count(DISTINCT ticker) FROM news) AS groups_read, "
    "(SELECT count(DISTINCT ticker) FROM classified WHERE action IN ('inserted', 'updated')) AS groups_written,", 1))
def upsert_partial_report(spark, sf_dir):
    report = _loaded(spark, sf_dir)[1]
    row = {k: v for k, v in report.items() if k != "changed"}
    schema = ("inserted bigint, updated bigint, unchanged bigint, retained bigint, total bigint, first_date date, last_date date, "
              "version int, groups_read bigint, groups_written bigint")
    return spark.createDataFrame([row], schema)


# --- A9 + A11: rebuild by manifest ------------------------------------------------------

# The download request of the manifest, and of one ticker that was asked for by the week.
REQUEST, OTHER_REQUEST, OTHERWISE_ASKED = "5y/1d", "5y/1wk", "4-NOT SPECIFIED"

BEFORE = ANNOTATED_BARS + f""",
raw_before AS (
    SELECT ticker, date, k, seq, open, high, low, close,
           volume + CASE WHEN ticker = '{fixtures.REVISED_TICKER}' AND (2 * k + seq) % {fixtures.REVISED_EVERY} = 0 THEN 1 ELSE 0 END AS volume
    FROM raw_bars WHERE ticker <> '{fixtures.NEW_TICKER}'
    UNION ALL
    SELECT '{fixtures.GONE_TICKER}', date, k, seq, open, high, low, close, volume FROM raw_bars WHERE ticker = '{fixtures.GONE_LIKE}'
)"""

# A ticker is as recorded if neither side has a raw bar that the other lacks.
PLAN_SQL = with_(BEFORE) + f""",
a AS (SELECT ticker, date, seq, open, high, low, close, volume FROM raw_bars),
b AS (SELECT ticker, date, seq, open, high, low, close, volume FROM raw_before),
differing AS (SELECT ticker FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION SELECT ticker FROM (SELECT * FROM b EXCEPT SELECT * FROM a)),
tickers AS (SELECT ticker, (SELECT count(*) FROM a WHERE a.ticker = t.ticker) AS now, (SELECT count(*) FROM b WHERE b.ticker = t.ticker) AS before
            FROM (SELECT ticker FROM a UNION SELECT ticker FROM b) t)
SELECT ticker, nullif(now, 0) AS rows,
       CASE WHEN before = 0 THEN 'added' WHEN now = 0 THEN 'removed' WHEN ticker IN (SELECT ticker FROM differing) THEN 'changed'
            WHEN ticker = '{OTHERWISE_ASKED}' THEN 'different_request' ELSE 'unchanged' END AS status,
       CASE WHEN now = 0 THEN 'drop' WHEN before > 0 AND ticker NOT IN (SELECT ticker FROM differing) AND ticker <> '{OTHERWISE_ASKED}'
            THEN 'keep' ELSE 'build' END AS action
FROM tickers"""


def _manifest(raw: DataFrame, request: str = REQUEST) -> DataFrame:
    return versions.manifest_of(bars.normalize(raw.drop("arrival")), "ticker", request)


@register("rebuild_plan", PLAN_SQL)
def rebuild_plan(spark, sf_dir):
    """What a run has to do for each ticker, by the recorded manifest."""
    recorded = _manifest(fixtures.raw_bars_before(spark, sf_dir))
    recorded = recorded.withColumn("request", F.when(F.col("ticker") == OTHERWISE_ASKED, OTHER_REQUEST).otherwise(F.col("request")))
    return versions.rebuild_plan(_manifest(fixtures.raw_bars(spark, sf_dir)), recorded, "ticker")


def _rebuilt(spark, sf_dir) -> tuple[str, list[bars_chain.BarsRebuild]]:
    """Three runs: the earlier bars, today's bars, today's bars once more."""
    base = _base(spark, "bars-rebuild")
    raws = [fixtures.raw_bars_before(spark, sf_dir), fixtures.raw_bars(spark, sf_dir), fixtures.raw_bars(spark, sf_dir)]
    return base, [bars_chain.bars_rebuild(spark, raw.drop("arrival"), base, REQUEST) for raw in raws]


REBUILT_SQL = f"'{fixtures.NEW_TICKER}', '{fixtures.REVISED_TICKER}'"


@register("rebuilt_bars", with_(ANNOTATED_BARS) + f"""
SELECT date, ticker, {', '.join(VALUES)}, CAST(CASE WHEN ticker IN ({REBUILT_SQL}) THEN 1 ELSE 0 END AS INTEGER) AS written FROM clean""")
def rebuilt_bars(spark, sf_dir):
    """The repaired bars after three runs: the second wrote the new and the revised ticker, the third nothing."""
    return with_writer(bars_chain.tables_of(spark, _rebuilt(spark, sf_dir)[0])[0])


RUNS_SQL = with_(BEFORE) + f""",
counts AS (SELECT (SELECT count(DISTINCT ticker) FROM raw_before) AS before, (SELECT count(DISTINCT ticker) FROM raw_bars) AS now),
revised AS (SELECT count(*) AS n FROM annotated a JOIN (SELECT ticker, date, max_by(k, seq) AS k, max(seq) AS seq FROM raw_before GROUP BY ALL) r USING (ticker, date)
            WHERE a.rule IS NULL AND ticker = '{fixtures.REVISED_TICKER}' AND (2 * r.k + r.seq) % {fixtures.REVISED_EVERY} = 0
              AND (SELECT volume FROM raw_bars v WHERE v.ticker = a.ticker AND v.date = a.date AND v.seq = r.seq) IS NOT NULL)
SELECT CAST(0 AS INTEGER) AS run, before AS built, CAST(0 AS BIGINT) AS dropped, CAST(0 AS BIGINT) AS kept,
       (SELECT count(*) FROM clean WHERE ticker <> '{fixtures.NEW_TICKER}') + (SELECT count(*) FROM clean WHERE ticker = '{fixtures.GONE_LIKE}') AS inserted,
       CAST(0 AS BIGINT) AS updated FROM counts
UNION ALL
SELECT 1, 2, 1, now - 2, (SELECT count(*) FROM clean WHERE ticker = '{fixtures.NEW_TICKER}'), (SELECT n FROM revised) FROM counts
UNION ALL
SELECT 2, 0, 0, now, 0, 0 FROM counts"""


@register("rebuild_runs", RUNS_SQL)
def rebuild_runs(spark, sf_dir):
    """What each of the three runs did: tickers built, dropped and kept, bars inserted and updated."""
    rows = [(k, len(r.built), len(r.dropped), r.kept, (r.load or {}).get("inserted", 0), (r.load or {}).get("updated", 0))
            for k, r in enumerate(_rebuilt(spark, sf_dir)[1])]
    return spark.createDataFrame(rows, "run int, built bigint, dropped bigint, kept bigint, inserted bigint, updated bigint")
