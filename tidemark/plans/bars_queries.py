"""Registered queries over the price bars (normalise, repair, validate, metrics)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.functions.numeric import sql_round
from tidemark.operators import bars, checks
from tidemark.operators.reshape import stack
from tidemark.plans.catalog import register
from tidemark.plans.sql_fixtures import ANNOTATED_BARS, METRICS, RAW_BARS, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures, io

# The volatility is a 30-row sum of squares; engines add it up in different
# orders, so it is compared at 6 decimals (relative noise is ~1e-16).
VOL_DIGITS = 6


def _arrived(spark, sf_dir):
    return bars.normalize(fixtures.raw_bars(spark, sf_dir))


def _normalized(spark, sf_dir):
    return _arrived(spark, sf_dir).drop("arrival")


def _annotated(spark, sf_dir):
    return bars.annotate_repairs(_normalized(spark, sf_dir))


def clean(spark, sf_dir):
    return bars.clean_bars(fixtures.raw_bars(spark, sf_dir).drop("arrival"))


def metrics(spark, sf_dir):
    return bars.bar_metrics(clean(spark, sf_dir))


# --- B1 + exchange-local date ------------------------------------------------------

NORMALIZED_SQL = with_(RAW_BARS) + """
SELECT date, ticker, open, high, low, close, volume,
       CAST(NULL AS DOUBLE) AS dividends, CAST(NULL AS DOUBLE) AS stock_splits, CAST(seq AS BIGINT) AS seq
FROM raw_bars
"""


@register("bars_normalized", NORMALIZED_SQL)
def bars_normalized(spark, sf_dir):
    return _normalized(spark, sf_dir)


# --- F1 ------------------------------------------------------------------------------

KEEP_LAST_SQL = with_(ANNOTATED_BARS) + """
SELECT ticker, date, open, high, low, close, volume,
       CAST(NULL AS DOUBLE) AS dividends, CAST(NULL AS DOUBLE) AS stock_splits, CAST(seq AS BIGINT) AS seq
FROM last_rows
"""


@register("bars_keep_last", KEEP_LAST_SQL)
def bars_keep_last(spark, sf_dir):
    return bars.keep_last(_normalized(spark, sf_dir), ["ticker", "date"], "seq")


# --- B6 --------------------------------------------------------------------------------

REPORT_SQL = with_(ANNOTATED_BARS) + """
SELECT * FROM (
    SELECT ticker, 'duplicate_date' AS rule, CAST(sum(duplicates) AS BIGINT) AS dropped FROM annotated GROUP BY ticker
    UNION ALL
    SELECT ticker, rule, count(*) AS dropped FROM annotated WHERE rule IS NOT NULL GROUP BY ticker, rule
) WHERE dropped > 0
"""


@register("bars_repair_report", REPORT_SQL)
def bars_repair_report(spark, sf_dir):
    return bars.report_from(_annotated(spark, sf_dir))


ANNOTATED_SQL = with_(ANNOTATED_BARS) + "SELECT * FROM annotated"


@register("bars_annotated", ANNOTATED_SQL)
def bars_annotated(spark, sf_dir):
    return _annotated(spark, sf_dir)


CLEAN_SQL = with_(ANNOTATED_BARS) + "SELECT * FROM clean"


@register("bars_clean", CLEAN_SQL)
def bars_clean(spark, sf_dir):
    return clean(spark, sf_dir)


# --- B2-B5 as stand-alone filters over the deduplicated bars ---------------------------

FILTERS_SQL = with_(ANNOTATED_BARS) + """
SELECT date, ticker, open, high, low, close, volume, dividends, stock_splits
FROM annotated
WHERE NOT (open IS NULL OR isnan(open) OR high IS NULL OR isnan(high) OR low IS NULL OR isnan(low)
           OR close IS NULL OR isnan(close))
  AND least(open, high, low, close) > 0
  AND high >= greatest(open, close) AND low <= least(open, close)
"""


@register("bars_rule_filters", FILTERS_SQL)
def bars_rule_filters(spark, sf_dir):
    last = bars.keep_last(_normalized(spark, sf_dir), ["ticker", "date"], "seq").drop("seq")
    out = bars.drop_inconsistent(bars.drop_nonpositive(bars.drop_incomplete(bars.fill_zero(last))))
    return out.select(*bars.OHLCV_COLUMNS)


# --- K8 -------------------------------------------------------------------------------

def _validation_sql(source: str, late: str = "(SELECT NULL AS ticker, 0 AS late)") -> str:
    """``late``: ticker and number of rows dated before the row that arrived before them."""
    return f"""
SELECT w.ticker,
       CAST(coalesce(v.rows, 0) AS BIGINT) AS rows,
       CAST(coalesce(v.duplicate_dates, 0) AS BIGINT) AS duplicate_dates,
       CAST(coalesce(a.late, 0) AS BIGINT) AS out_of_order,
       CAST(coalesce(v.missing_prices, 0) AS BIGINT) AS missing_prices,
       CAST(coalesce(v.nonpositive_prices, 0) AS BIGINT) AS nonpositive_prices,
       CAST(coalesce(v.unbracketed, 0) AS BIGINT) AS unbracketed,
       CAST(CASE WHEN coalesce(v.rows, 0) = 0 THEN 1 ELSE 0 END + coalesce(v.duplicate_dates, 0)
            + coalesce(a.late, 0) + coalesce(v.missing_prices, 0) + coalesce(v.nonpositive_prices, 0)
            + coalesce(v.unbracketed, 0) AS BIGINT) AS failures
FROM (SELECT DISTINCT ticker FROM raw_bars) w
LEFT JOIN (
    SELECT ticker, count(*) AS rows, count(date) - count(DISTINCT date) AS duplicate_dates,
           count(*) FILTER (WHERE open IS NULL OR isnan(open) OR high IS NULL OR isnan(high)
                            OR low IS NULL OR isnan(low) OR close IS NULL OR isnan(close)) AS missing_prices,
           count(*) FILTER (WHERE coalesce(open <= 0 OR high <= 0 OR low <= 0 OR close <= 0, false)) AS nonpositive_prices,
           count(*) FILTER (WHERE coalesce(high < greatest(open, close) OR low > least(open, close), false)) AS unbracketed
    FROM {source} GROUP BY ticker
) v USING (ticker) LEFT JOIN {late} a USING (ticker)
"""


LATE_SQL = """(SELECT ticker, count(*) FILTER (WHERE date < before) AS late
    FROM (SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY k, seq) AS before FROM raw_bars) GROUP BY ticker)"""
VALIDATION_RAW_SQL = with_(RAW_BARS) + _validation_sql("raw_bars", LATE_SQL)
VALIDATION_CLEAN_SQL = with_(ANNOTATED_BARS) + _validation_sql("clean")


def _wanted(spark, sf_dir):
    return fixtures.raw_bars(spark, sf_dir).select("ticker")


@register("bars_validation_raw", VALIDATION_RAW_SQL)
def bars_validation_raw(spark, sf_dir):
    """K8 on the rows as they arrive, their order among them."""
    return checks.validate_bars(_arrived(spark, sf_dir), _wanted(spark, sf_dir), arrival="arrival")


@register("bars_validation", VALIDATION_CLEAN_SQL)
def bars_validation(spark, sf_dir):
    return checks.validate_bars(clean(spark, sf_dir), _wanted(spark, sf_dir))


CHECK_BARS_SQL = "SELECT 'bars_valid' AS check_id, CAST(sum(rows) AS BIGINT) AS rows_checked, " \
    "CAST(sum(failures) AS BIGINT) AS violations, " \
    "CASE WHEN sum(failures) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict " \
    f"FROM ({VALIDATION_CLEAN_SQL})"


@register("check_bars", CHECK_BARS_SQL)
def check_bars(spark, sf_dir):
    return checks.check_bars(bars_validation(spark, sf_dir))


# --- E7-E10 --------------------------------------------------------------------------

METRICS_SQL = with_(METRICS) + f"""
SELECT date, ticker, open, high, low, close, volume, indexed_close, daily_return_pct, drawdown_pct,
       {sql_round('volatility_30d_pct', VOL_DIGITS)} AS volatility_30d_pct
FROM metrics
"""


def _rounded_metrics(spark, sf_dir):
    m = metrics(spark, sf_dir)
    return m.withColumn("volatility_30d_pct", F.round("volatility_30d_pct", VOL_DIGITS))


@register("ticker_metrics", METRICS_SQL)
def ticker_metrics(spark, sf_dir):
    return _rounded_metrics(spark, sf_dir)


# --- B10 ------------------------------------------------------------------------------

# The dashboard's filters: a date range and a ticker selection.
DASHBOARD_START = dt.date(1993, 1, 1)
DASHBOARD_END = dt.date(1997, 12, 31)
DASHBOARD_TICKERS = ("1-URGENT", "2-HIGH", "5-LOW")

FILTERED_SQL = with_(METRICS) + f"""
SELECT date, ticker, open, high, low, close, volume, indexed_close, daily_return_pct, drawdown_pct,
       {sql_round('volatility_30d_pct', VOL_DIGITS)} AS volatility_30d_pct
FROM metrics
WHERE date BETWEEN DATE '{DASHBOARD_START}' AND DATE '{DASHBOARD_END}'
  AND ticker IN ({", ".join(f"'{t}'" for t in DASHBOARD_TICKERS)})
"""


@register("dashboard_filter", FILTERED_SQL)
def dashboard_filter(spark, sf_dir):
    return bars.filter_bars(_rounded_metrics(spark, sf_dir), DASHBOARD_START, DASHBOARD_END, DASHBOARD_TICKERS)


# --- D11 --------------------------------------------------------------------------------

DISTRIBUTION_SQL = with_(METRICS) + """,
stats AS (
    SELECT ticker, count(*) AS n, min(daily_return_pct) AS min,
           quantile_disc(daily_return_pct, 0.25) AS q1,
           quantile_disc(daily_return_pct, 0.5)  AS median,
           quantile_disc(daily_return_pct, 0.75) AS q3,
           max(daily_return_pct) AS max
    FROM metrics WHERE daily_return_pct IS NOT NULL GROUP BY ticker
),
fenced AS (
    SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM stats
)
SELECT f.*, (SELECT count(*) FROM metrics m WHERE m.ticker = f.ticker
             AND (m.daily_return_pct < f.lower_fence OR m.daily_return_pct > f.upper_fence)) AS outliers
FROM fenced f
"""


@register("return_distribution", DISTRIBUTION_SQL)
def return_distribution(spark, sf_dir):
    """The box plot with quartiles from the bounded sketch (exact below 10,000 rows a ticker)."""
    return bars.return_distribution(metrics(spark, sf_dir), exact=False)


@register("return_distribution_exact", DISTRIBUTION_SQL)
def return_distribution_exact(spark, sf_dir):
    """The same box plot with exact quartiles (bracket, count below, walk the band)."""
    return bars.return_distribution(metrics(spark, sf_dir), exact=True)


# --- D12 --------------------------------------------------------------------------------

SCOREBOARD_SQL = with_(METRICS) + f"""
SELECT ticker, max(date) AS last_date,
       arg_max(close, date) AS close, arg_max(indexed_close, date) AS indexed_close,
       arg_max(daily_return_pct, date) AS daily_return_pct, arg_max(drawdown_pct, date) AS drawdown_pct,
       {sql_round('arg_max(volatility_30d_pct, date)', VOL_DIGITS)} AS volatility_30d_pct
FROM metrics GROUP BY ticker
"""


@register("scoreboard", SCOREBOARD_SQL)
def scoreboard(spark, sf_dir):
    return bars.scoreboard(_rounded_metrics(spark, sf_dir))


# --- F5 ---------------------------------------------------------------------------------

@register("bars_chronological", with_(ANNOTATED_BARS) + "SELECT * FROM clean ORDER BY ticker, date")
def bars_chronological(spark, sf_dir):
    return clean(spark, sf_dir).orderBy("ticker", "date")


# --- A3 / A5: written by ticker and read back ---------------------------------------------

READ_BACK = ("1-URGENT", "3-MEDIUM")


@register("bars_read_back", with_(ANNOTATED_BARS) + f"""
SELECT date, ticker, open, high, low, close, volume, dividends, stock_splits FROM clean WHERE ticker IN {READ_BACK!r}""")
def bars_read_back(spark, sf_dir):
    """Bars partitioned by ticker in the shared folder, two of the partitions read."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bars-{uuid.uuid4().hex}"
    io.write_bars(clean(spark, sf_dir), path)
    return io.scan_bars(spark, path, READ_BACK).select("date", "ticker", *bars.OHLCV_COLUMNS[2:])


@register("bars_read_back_whole", with_(ANNOTATED_BARS) + """
SELECT date, ticker, open, high, low, close, volume, dividends, stock_splits FROM clean""")
def bars_read_back_whole(spark, sf_dir):
    """The same dataset read without a list of tickers."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bars-{uuid.uuid4().hex}"
    io.write_bars(clean(spark, sf_dir), path)
    return io.scan_bars(spark, path).select("date", "ticker", *bars.OHLCV_COLUMNS[2:])


# Fixed value: rows of a file of the dataset.
FILE_ROWS = 1_000_000


@register("dataset_read_back", with_(ANNOTATED_BARS) + """
SELECT date, ticker, close, (SELECT count(*) FROM clean) AS reported FROM clean""")
def dataset_read_back(spark, sf_dir):
    """A dataset written by the plan's own tasks and read again, with the rows that the write reported."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dataset-{uuid.uuid4().hex}"
    report = io.write_dataset(clean(spark, sf_dir), path, max_records=FILE_ROWS)
    return io.scan(spark, path).select("date", "ticker", "close", F.lit(report["rows"]).cast("long").alias("reported"))


# --- G2 -----------------------------------------------------------------------------------

@register("bars_stacked", with_(ANNOTATED_BARS) + """
SELECT date, ticker, close, close > open AS rising FROM clean""")
def bars_stacked(spark, sf_dir):
    """Tickers' frames stacked by column name, whatever the order of their columns; together they hold every bar."""
    c = clean(spark, sf_dir).select("date", "ticker", "close", (F.col("close") > F.col("open")).alias("rising"))
    rest = c.where("ticker >= '3' OR ticker IS NULL")
    return stack([c.where("ticker < '3'"), rest.select("rising", "close", "ticker", "date")])
