"""Daily price bars: normalise, repair, metrics and dashboard summaries.

Inventory: B1-B6, B10, F1, F5, E7-E10, D11, D12, A13 (K8 lives in checks).

Repairs run in one pass. Rows of one (ticker, date) collapse to the last by
``seq`` with ``max_by`` (a partial aggregation: a date repeated a million times
costs one buffer per map task), then a single CASE names the first rule the
survivor breaks. Clean rows and the per-rule report both come from that
annotated table.

Metrics are windows over a ticker's history. (ticker, date) is unique there, so
a ticker has at most one bar per calendar day, which bounds its window.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import exchange_local_date
from tidemark.operators.profile import exact_quantiles
from tidemark.operators.joins import keyed_join

# Column roles of a bar.
PRICE_COLUMNS = ("open", "high", "low", "close")
FILLABLE_COLUMNS = ("volume", "dividends", "stock_splits")
OHLCV_COLUMNS = ("date", "ticker", "open", "high", "low", "close", "volume", "dividends", "stock_splits")
# Rule names in the order they are applied.
RULES = ("duplicate_date", "incomplete", "nonpositive", "inconsistent")
# Annualisation and the volatility frame.
TRADING_DAYS = 252
VOLATILITY_ROWS = 30



# --- normalising (B1, A13) -------------------------------------------------------

def snake_case(df: DataFrame) -> DataFrame:
    """Lower-case names with blanks as underscores (B1)."""
    return df.withColumnsRenamed({c: c.lower().replace(" ", "_") for c in df.columns})


def conform(df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """Exactly ``columns`` in that order, cast where typed; raise listing any missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"frame is missing columns: {', '.join(missing)}")
    types = types or {}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in columns])


def normalize(raw: DataFrame, ts: str = "ts", zone: str = "exchange_tz") -> DataFrame:
    """snake_case names and the exchange-local calendar date in place of the instant."""
    df = snake_case(raw)
    ts, zone = ts.lower(), zone.lower()
    rest = [c for c in df.columns if c not in (ts, zone)]
    return df.select(exchange_local_date(ts, zone).alias("date"), *rest)


# --- the individual repairs (B2-B5, F1) -------------------------------------------

def _missing(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(F.col(c))


def fill_zero(df: DataFrame, cols: Sequence[str] = FILLABLE_COLUMNS) -> DataFrame:
    """NULL or NaN becomes 0 in the listed columns that exist; volume stays integral (B2)."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        dtype = dict(df.dtypes)[c]
        if dtype in ("double", "float"):
            out = out.withColumn(c, F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)))
        else:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("long" if c == "volume" else dtype))
    return out


def incomplete(prices: Sequence[str] = PRICE_COLUMNS) -> Column:
    cond = F.lit(False)
    for p in prices:
        cond = cond | _missing(p)
    return cond


def nonpositive(prices: Sequence[str] = PRICE_COLUMNS) -> Column:
    return F.least(*[F.col(p) for p in prices]) <= 0


def inconsistent() -> Column:
    return ~((F.col("high") >= F.greatest("open", "close")) & (F.col("low") <= F.least("open", "close")))


def drop_incomplete(df: DataFrame, prices: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Drop any bar with a NULL or NaN price; never fill."""
    return df.where(~incomplete(prices))


def drop_nonpositive(df: DataFrame, prices: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Keep bars whose prices are all > 0."""
    return df.where(F.least(*[F.col(p) for p in prices]) > 0)


def drop_inconsistent(df: DataFrame) -> DataFrame:
    """Keep bars whose high/low bracket open and close."""
    return df.where(~inconsistent())


# A row's place among the rows of its key: its sequence number, then a hash of its values.
_HASH_RANGE = Decimal(1 << 63)
_MASK = (1 << 63) - 1


def _places(df: DataFrame, seq: str) -> tuple[Column, Column]:
    """(place, place with the hash turned round): one exact number each, so both have plain aggregation buffers."""
    kind = dict(df.dtypes)[seq]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{seq} must be an integer, got {kind}")
    above = _number(F.col(seq)) * F.lit(_HASH_RANGE)
    tag = F.xxhash64(*[F.col(c) for c in df.columns]).bitwiseAND(F.lit(_MASK))
    return (above + tag.cast("decimal(19,0)")).cast("decimal(38,0)"), (above + (F.lit(_MASK) - tag).cast("decimal(19,0)")).cast("decimal(38,0)")


def _number(seq: Column) -> Column:
    """The sequence number; a row without one is before all others."""
    return F.coalesce(seq.cast("decimal(19,0)"), F.lit(-_HASH_RANGE - 1))


def keep_last(df: DataFrame, keys: Sequence[str], seq: str, count_as: str | None = None, tie_as: str | None = None) -> DataFrame:
    """The whole row with the largest ``seq`` per key (F1).

    A row without ``seq`` counts as older than any with one. Among rows of the
    largest ``seq`` a hash of the row decides, so every column comes from one
    row and the choice does not depend on order or partitioning; with
    ``tie_as``, a column says whether rows that differ shared it (rows equal in
    every column are no tie).

    ``max_by`` is a partial aggregation, so a key repeated many times is reduced
    in the map tasks before anything is shuffled. One ``max_by`` per column
    (all by the same place, which no two different rows share) keeps plain
    buffers and so the hash aggregate; a struct would force a sort aggregate.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    place, turned = _places(df, seq)
    placed = df.withColumns({"_place": place, "_turned": turned})
    aggs = [F.max_by(F.col(c), F.col("_place")).alias(c) if c != seq else F.max(seq).alias(c) for c in rest]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    if tie_as:
        # Each hash and its turn add up to the mask, if both come from one row.
        above = (_number(F.max(seq)) * F.lit(_HASH_RANGE)).cast("decimal(38,0)")
        tags = (F.max("_place") - above) + (F.max("_turned") - above)
        aggs.append((tags != F.lit(_MASK)).alias(tie_as))
    return placed.groupBy(*keys).agg(*aggs)


# --- one-pass repair (B6) ---------------------------------------------------------

def annotate_repairs(
    bars: DataFrame, keys: Sequence[str] = ("ticker", "date"), seq: str = "seq", tie_as: str | None = None
) -> DataFrame:
    """One row per (ticker, date) survivor with ``rule`` (NULL = kept) and ``duplicates``.

    With ``tie_as`` also whether different rows shared the largest ``seq``.

    Rules apply in the order duplicate -> fill -> incomplete -> nonpositive ->
    inconsistent; a row is attributed to the first rule it breaks. The fill runs
    before the price rules, so a missing volume never drops a bar.
    """
    last = keep_last(bars, keys, seq, count_as="_n", tie_as=tie_as)
    filled = fill_zero(last)
    rule = (
        F.when(incomplete(), F.lit("incomplete"))
        .when(nonpositive(), F.lit("nonpositive"))
        .when(inconsistent(), F.lit("inconsistent"))
    )
    return filled.select(
        *[c for c in filled.columns if c not in ("_n", seq)],
        rule.alias("rule"),
        (F.col("_n") - 1).alias("duplicates"),
    )


def clean_from(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("rule").isNull()).drop("rule", "duplicates")


def ties_from(annotated: DataFrame, tie: str, ticker: str = "ticker") -> DataFrame:
    """(ticker, ties): days on which different rows were the last one, for tickers that have any."""
    return annotated.groupBy(ticker).agg(F.count_if(F.col(tie)).alias("ties")).where("ties > 0")


def report_from(annotated: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Rows dropped per ticker and rule (only rules that dropped something)."""
    per = annotated.groupBy(ticker).agg(
        F.sum("duplicates").alias("duplicate_date"),
        *[F.count_if(F.col("rule") == r).alias(r) for r in RULES[1:]],
    )
    stacked = per.select(ticker, F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).cast("long").alias("dropped")) for r in RULES
    ])).alias("r")).select(ticker, "r.rule", "r.dropped")
    return stacked.where(F.col("dropped") > 0)


def repair(bars: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(clean bars, per-ticker per-rule drop report) from one annotated plan.

    Persist ``annotate_repairs`` yourself when both outputs are materialised.
    """
    annotated = annotate_repairs(bars, seq=seq)
    return clean_from(annotated), report_from(annotated)


def clean_bars(raw: DataFrame) -> DataFrame:
    """normalise -> repair -> the ``ohlcv`` table shape."""
    clean = clean_from(annotate_repairs(normalize(raw)))
    return conform(clean, OHLCV_COLUMNS, {"volume": "long"})


# --- metrics (E7-E10) --------------------------------------------------------------

def bar_metrics(
    ohlcv: DataFrame,
    ticker: str = "ticker",
    date: str = "date",
    close: str = "close",
) -> DataFrame:
    """The ticker metrics view: indexed close, daily return %, drawdown %, 30-row volatility %.

    * indexed_close = 100 * close / first close of the ticker
    * daily_return_pct = 100 * (close / previous close - 1), NULL on the first
      bar or a zero previous close
    * drawdown_pct = 100 * (close / running max close - 1), always <= 0
    * volatility_30d_pct = 100 * sqrt(252) * sample sd of the returns in the
      30 rows ending here (NULLs skipped, no minimum)

    Output keeps the input columns except dividends and splits. (ticker, date)
    must be unique, so a ticker has at most one bar per calendar day: that
    bounds its window (3,652,059 days are all that Spark's dates hold), and a
    ticker is never cut. Bars without a ticker form one series.
    """
    c = F.col(close)
    history = Window.partitionBy(ticker).orderBy(date)
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    recent = history.rowsBetween(1 - VOLATILITY_ROWS, Window.currentRow)
    growth = c / F.nullif(F.lag(close).over(history), F.lit(0.0)) - 1
    # Only the volatility needs the returns as rows; the rest are windows over the closes.
    grown = ohlcv.withColumn("_growth", growth)
    yearly = F.lit(100.0) * F.sqrt(F.lit(float(TRADING_DAYS)))
    return grown.select(
        *_metric_columns(ohlcv.columns),
        (F.lit(100.0) * c / F.first(close).over(so_far)).alias("indexed_close"),
        (F.lit(100.0) * F.col("_growth")).alias("daily_return_pct"),
        (F.lit(100.0) * (c / F.max(close).over(so_far) - 1)).alias("drawdown_pct"),
        (yearly * F.stddev_samp("_growth").over(recent)).alias("volatility_30d_pct"),
    )


def _metric_columns(cols: list[str]) -> list[str]:
    return [c for c in cols if c not in FILLABLE_COLUMNS[1:]]


# --- dashboard summaries (B10, D11, D12) --------------------------------------------

def filter_bars(df: DataFrame, start=None, end=None, tickers: Sequence[str] | None = None,
                date: str = "date", ticker: str = "ticker") -> DataFrame:
    """The dashboard's two filters, each optional (B10); both reach the parquet scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(date) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(date) <= F.lit(end))
    if tickers is not None:
        cond = cond & F.col(ticker).isin(list(tickers))
    return df.where(cond)


# The quartiles of a box plot.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def return_distribution(metrics: DataFrame, ticker: str = "ticker", value: str = "daily_return_pct",
                        accuracy: int = 10_000, exact: bool = True) -> DataFrame:
    """Box-plot figures of the daily returns per ticker.

    n, min, q1, median, q3, max, iqr, whisker fences at 1.5 * IQR and the count
    of returns outside them. Quartiles are data values at rank ceil(p * n): exact
    at any size (``profile.exact_quantiles``, which sorts no ticker in one
    task), or with ``exact=False`` from a bounded quantile sketch in the same
    aggregation as the other figures (rank error <= n / accuracy). A NULL
    ticker is a group like any other.
    """
    r = metrics.select(ticker, value).where(F.col(value).isNotNull())
    figures = [F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max")]
    if exact:
        stats = keyed_join(r.groupBy(ticker).agg(*figures), exact_quantiles(r, [ticker], value, QUARTILES), [ticker])
    else:
        sketch = F.percentile_approx(value, list(QUARTILES.values()), accuracy)
        stats = r.groupBy(ticker).agg(*figures, sketch.alias("_q")).select(
            ticker, "n", "min", "max", *[F.col("_q")[i].alias(q) for i, q in enumerate(QUARTILES)])
    spread = F.col("q3") - F.col("q1")
    stats = stats.select(
        ticker, "n", "min", "q1", "median", "q3", "max", spread.alias("iqr"),
        (F.col("q1") - F.lit(1.5) * spread).alias("lower_fence"), (F.col("q3") + F.lit(1.5) * spread).alias("upper_fence"),
    )
    fences = stats.select(ticker, "lower_fence", "upper_fence")
    outside = keyed_join(r, fences, [ticker]).groupBy(ticker).agg(
        F.count_if((F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))).alias("outliers"))
    return keyed_join(stats, outside, [ticker])


def scoreboard(metrics: DataFrame, ticker: str = "ticker", date: str = "date",
               measures: Sequence[str] = ("close", "indexed_close", "daily_return_pct",
                                          "drawdown_pct", "volatility_30d_pct")) -> DataFrame:
    """Latest value of each metric per ticker (D12), via partial ``max_by`` aggregates.

    Dates are unique per ticker, so every ``max_by`` picks the same (latest) bar.
    """
    return metrics.groupBy(ticker).agg(
        F.max(date).alias("last_date"),
        *[F.max_by(F.col(m), F.col(date)).alias(m) for m in measures],
    )

