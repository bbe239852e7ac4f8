"""DuckDB twins of ``tidemark.sources.fixtures``, as CTE text for oracle queries.

The oracle side is written independently of the Spark side: plain window
functions and GROUP BYs over the raw tables, the way a SQL user would check the
numbers.
"""

from __future__ import annotations

# Mirror tidemark.sources.fixtures.
READINGS = """readings AS (
    SELECT lpad(CAST(e.user_id AS VARCHAR), 7, '0') AS sensor_id,
           CAST(e.ts AS DATE)                        AS reading_date,
           r.r_name                                  AS location,
           e.event_type                              AS parameter,
           e.value                                   AS value,
           CASE WHEN e.value > 150.0 THEN 'Bad' ELSE 'Good' END AS status,
           e.event_id                                AS seq
    FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5
)"""

# Mirror the NULLs and defects of fixtures.readings_with_nulls and broken_readings.
NULL_READINGS = READINGS + """,
null_readings AS (
    SELECT CASE WHEN seq % 17 <> 0 THEN sensor_id END AS sensor_id, reading_date,
           CASE WHEN seq % 29 <> 0 THEN location END AS location,
           CASE WHEN seq % 23 <> 0 THEN parameter END AS parameter, value, status, seq
    FROM readings
)"""

BROKEN_READINGS = NULL_READINGS + """,
broken_readings AS (
    SELECT CASE WHEN seq % 41 = 0 THEN 'X-' || sensor_id ELSE sensor_id END AS sensor_id, reading_date,
           CASE WHEN seq % 31 = 0 THEN 'ELSEWHERE' ELSE location END AS location, parameter, value,
           CASE WHEN seq % 37 = 0 THEN 'Odd' ELSE status END AS status, seq
    FROM null_readings
)"""

BASE_BARS = """base_bars AS (
    SELECT o_orderpriority                      AS ticker,
           CAST(o_orderdate AS DATE)            AS date,
           min(o_orderkey)                      AS k,
           arg_min(o_totalprice, o_orderkey)    AS open,
           max(o_totalprice)                    AS high,
           min(o_totalprice)                    AS low,
           arg_max(o_totalprice, o_orderkey)    AS close,
           count(*)                             AS volume
    FROM orders
    GROUP BY 1, 2
)"""

# Raw bars with the timestamp already reduced to the exchange-local date.
RAW_BARS = BASE_BARS + """,
raw_union AS (
    SELECT ticker, date, k, open, high, low, close, volume, 0 AS seq FROM base_bars
    UNION ALL
    SELECT ticker, date, k, open, high, low, (high + low) / 2 AS close, volume, 1 AS seq
    FROM base_bars WHERE k % 43 = 0
),
raw_bars AS (
    SELECT ticker, date, k, seq,
           CASE WHEN k % 59 = 0 THEN CAST(0.0 AS DOUBLE) ELSE open END   AS open,
           CASE WHEN k % 61 = 0 THEN close / 2 ELSE high END              AS high,
           low,
           CASE WHEN k % 53 = 0 THEN CAST(NULL AS DOUBLE) ELSE close END AS close,
           CASE WHEN k % 47 = 0 THEN CAST(NULL AS BIGINT) ELSE volume END AS volume
    FROM raw_union
)"""

OHLCV = BASE_BARS + """,
ohlcv AS (
    SELECT date, ticker, open, high, low, close, volume,
           CAST(0.0 AS DOUBLE) AS dividends, CAST(0.0 AS DOUBLE) AS stock_splits
    FROM base_bars
)"""

def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

# Repairs: last row per (ticker, date) by seq, the zero fill, then the first
# failing rule. Written the plain way (row_number over each cell).
ANNOTATED_BARS = RAW_BARS + """,
last_rows AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) AS rn,
                  count(*) OVER (PARTITION BY ticker, date) AS n
        FROM raw_bars)
    WHERE rn = 1
),
annotated AS (
    SELECT date, ticker, open, high, low, close,
           coalesce(volume, 0)                 AS volume,
           CAST(0.0 AS DOUBLE)                 AS dividends,
           CAST(0.0 AS DOUBLE)                 AS stock_splits,
           CASE WHEN open IS NULL OR isnan(open) OR high IS NULL OR isnan(high)
                  OR low IS NULL OR isnan(low) OR close IS NULL OR isnan(close) THEN 'incomplete'
                WHEN least(open, high, low, close) <= 0 THEN 'nonpositive'
                WHEN NOT (high >= greatest(open, close) AND low <= least(open, close)) THEN 'inconsistent'
           END                                 AS rule,
           n - 1                               AS duplicates
    FROM last_rows
),
clean AS (
    SELECT date, ticker, open, high, low, close, volume, dividends, stock_splits
    FROM annotated WHERE rule IS NULL
)"""

# The bar metrics from self-joins on a bar's place in its ticker, without a frame.
METRICS = ANNOTATED_BARS + """,
placed AS (
    SELECT *, (SELECT count(*) FROM clean o WHERE o.ticker = c.ticker AND o.date <= c.date) AS place FROM clean c
),
moves AS (
    SELECT b.ticker, b.place, CASE WHEN a.close <> 0 THEN b.close / a.close - 1 END AS move
    FROM placed b LEFT JOIN placed a ON a.ticker = b.ticker AND a.place = b.place - 1
),
heights AS (
    SELECT b.ticker, b.place, max(a.close) AS top, arg_min(a.close, a.place) AS base
    FROM placed b JOIN placed a ON a.ticker = b.ticker AND a.place <= b.place
    GROUP BY b.ticker, b.place
),
wobble AS (
    SELECT b.ticker, b.place, stddev_samp(a.move) AS sd
    FROM moves b JOIN moves a ON a.ticker = b.ticker AND a.place > b.place - 30 AND a.place <= b.place
    GROUP BY b.ticker, b.place
),
metrics AS (
    SELECT p.date, p.ticker, p.open, p.high, p.low, p.close, p.volume,
           100.0 * p.close / h.base AS indexed_close, 100.0 * m.move AS daily_return_pct,
           100.0 * (p.close / h.top - 1) AS drawdown_pct, 100.0 * sqrt(252) * w.sd AS volatility_30d_pct
    FROM placed p JOIN heights h USING (ticker, place) JOIN moves m USING (ticker, place) JOIN wobble w USING (ticker, place)
)"""

UPSERT = ANNOTATED_BARS + """,
clean_keyed AS (SELECT c.*, b.k FROM clean c JOIN base_bars b USING (ticker, date)),
target AS (
    SELECT date, ticker, open, high, low, close,
           CASE WHEN k % 11 = 0 THEN volume + 1 ELSE volume END AS volume,
           dividends, stock_splits
    FROM clean_keyed WHERE k % 7 <> 0
),
incoming AS (
    SELECT date, ticker, open, high, low, close, volume, dividends, stock_splits
    FROM clean_keyed WHERE k % 13 <> 0
)"""
