"""Operator inputs derived from the driver's tables (see FIXTURES.md §2).

Every fixture is a lazy plan over a whole table: nothing is sampled, capped or
subset. The bar fixtures inject defects at deterministic positions (a key
divisible by a small prime) so each cleaning rule has rows to act on; every row
of ``orders`` still flows through every fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.sources.tables import table

# The fixture contract of FIXTURES.md.
SENSOR_ID_WIDTH = 7
BAD_ABOVE = 150.0
LOCATION_OF_USER_MOD = 5

# Defect injection for the raw bars and the upsert batches,
# applied where the bar's first order key is divisible by the prime.
CORRECTION_EVERY = 43
ZERO_OPEN_EVERY = 59
HALF_HIGH_EVERY = 61
NULL_CLOSE_EVERY = 53
NULL_VOLUME_EVERY = 47
TARGET_MISSING_EVERY = 7
TARGET_BUMPED_VOLUME_EVERY = 11
INCOMING_MISSING_EVERY = 13

# Which exchange each ticker trades on. Bars are stamped at local
# midnight, so Tokyo's bars fall on the previous day in UTC.
DEFAULT_ZONE = "America/New_York"
TICKER_ZONES = {"1-URGENT": "Asia/Tokyo", "3-MEDIUM": "Europe/Amsterdam"}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings: events joined to the region of their user.

    Columns: sensor_id, reading_date, location, parameter, value, status, seq.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = lookup_join(
        events, region, (events.user_id % LOCATION_OF_USER_MOD) == region.r_regionkey
    )
    return joined.select(
        F.lpad(F.col("user_id").cast("string"), SENSOR_ID_WIDTH, "0").alias("sensor_id"),
        F.to_date("ts").alias("reading_date"),
        F.col("r_name").alias("location"),
        F.col("event_type").alias("parameter"),
        F.col("value").alias("value"),
        F.when(F.col("value") > BAD_ABOVE, F.lit("Bad")).otherwise(F.lit("Good")).alias("status"),
        F.col("event_id").alias("seq"),
    )


def base_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean daily bars: one per (order priority, order date) of ``orders``.

    Columns: ticker, date, k (first order key of the bar), open, high, low,
    close, volume. One aggregation, partial before the shuffle.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"
    )
    return orders.groupBy(
        F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("date")
    ).agg(
        F.min("o_orderkey").alias("k"),
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count("*").alias("volume"),
    )


def _zone(ticker: str = "ticker"):
    expr = F.lit(DEFAULT_ZONE)
    for name, zone in TICKER_ZONES.items():
        expr = F.when(F.col(ticker) == name, F.lit(zone)).otherwise(expr)
    return expr


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a download would deliver them, with corrections and defects.

    Columns: ticker, exchange_tz, ts (instant of local midnight), Open, High,
    Low, Close, Volume, Dividends, Stock Splits, seq (arrival order within a
    (ticker, date): 0 for the original, 1 for a later correction), arrival
    (unique, by order key: the dates do not arrive in order).
    """
    k = F.col("k")
    versions = F.when(k % CORRECTION_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = base_bars(spark, sf_dir).withColumn("seq", F.explode(versions))
    # Both rows of a corrected bar come from the one aggregation.
    close = F.when(F.col("seq") == 1, (F.col("high") + F.col("low")) / 2).otherwise(F.col("close"))
    rows = rows.withColumn("close", close)
    zone = _zone()
    return rows.select(
        "ticker",
        zone.alias("exchange_tz"),
        F.make_timestamp(
            F.year("date"), F.month("date"), F.dayofmonth("date"), F.lit(0), F.lit(0), F.lit(0), zone
        ).alias("ts"),
        F.when(k % ZERO_OPEN_EVERY == 0, F.lit(0.0)).otherwise(F.col("open")).alias("Open"),
        F.when(k % HALF_HIGH_EVERY == 0, F.col("close") / 2).otherwise(F.col("high")).alias("High"),
        F.col("low").alias("Low"),
        F.when(k % NULL_CLOSE_EVERY == 0, F.lit(None).cast("double")).otherwise(F.col("close")).alias("Close"),
        F.when(k % NULL_VOLUME_EVERY == 0, F.lit(None).cast("long")).otherwise(F.col("volume")).alias("Volume"),
        F.lit(None).cast("double").alias("Dividends"),
        F.lit(None).cast("double").alias("Stock Splits"),
        F.col("seq").cast("long").alias("seq"),
        (k * 2 + F.col("seq")).cast("long").alias("arrival"),
    )


# Rows of the readings that lose a key, by event id.
NULL_SENSOR_EVERY, NULL_PARAMETER_EVERY, NULL_LOCATION_EVERY = 17, 23, 29


def readings_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` with some sensors, parameters and locations unknown."""
    out = readings(spark, sf_dir)
    for column, every in (("sensor_id", NULL_SENSOR_EVERY), ("parameter", NULL_PARAMETER_EVERY), ("location", NULL_LOCATION_EVERY)):
        out = out.withColumn(column, F.when(F.col("seq") % every != 0, F.col(column)))
    return out


def broken_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` that fail checks: NULLs, sensors in two places, unknown states and ids of a wrong form."""
    n = F.col("seq")
    return readings_with_nulls(spark, sf_dir).withColumns({
        "location": F.when(n % 31 == 0, F.lit("ELSEWHERE")).otherwise(F.col("location")),
        "status": F.when(n % 37 == 0, F.lit("Odd")).otherwise(F.col("status")),
        "sensor_id": F.when(n % 41 == 0, F.concat(F.lit("X-"), F.col("sensor_id"))).otherwise(F.col("sensor_id")),
    })


def ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean bars in the ``ohlcv`` table shape (date, ticker, 7 values)."""
    return base_bars(spark, sf_dir).select(
        "date", "ticker", "open", "high", "low", "close", "volume",
        F.lit(0.0).alias("dividends"), F.lit(0.0).alias("stock_splits"),
    )


def _clean_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired bars (normalise + repair of ``raw_bars``) with their bar key ``k``."""
    from tidemark.operators.bars import clean_bars

    keys = base_bars(spark, sf_dir).select("ticker", "date", "k")
    return clean_bars(raw_bars(spark, sf_dir).drop("arrival")).join(keys, ["ticker", "date"])


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table before a load: repaired bars with some missing and some volumes differing."""
    k = F.col("k")
    return _clean_with_key(spark, sf_dir).where(k % TARGET_MISSING_EVERY != 0).select(
        "date", "ticker", "open", "high", "low", "close",
        F.when(k % TARGET_BUMPED_VOLUME_EVERY == 0, F.col("volume") + 1).otherwise(F.col("volume")).alias("volume"),
        "dividends", "stock_splits",
    )


def upsert_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch being loaded: the repaired bars minus some the target keeps."""
    return _clean_with_key(spark, sf_dir).where(F.col("k") % INCOMING_MISSING_EVERY != 0).select(
        "date", "ticker", "open", "high", "low", "close", "volume", "dividends", "stock_splits",
    )


# What differed in the raw bars of an earlier download. One ticker
# was not there yet, one has since been revised, one is gone today.
NEW_TICKER, REVISED_TICKER, GONE_TICKER, GONE_LIKE = "1-URGENT", "2-HIGH", "6-GONE", "5-LOW"
REVISED_EVERY = 5


def raw_bars_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_bars`` as an earlier download delivered them."""
    raw = raw_bars(spark, sf_dir)
    old = raw.where(F.col("ticker") != NEW_TICKER).withColumn(
        "Volume", F.when((F.col("ticker") == REVISED_TICKER) & (F.col("arrival") % REVISED_EVERY == 0), F.col("Volume") + 1).otherwise(F.col("Volume")))
    return old.unionByName(raw.where(F.col("ticker") == GONE_LIKE).withColumn("ticker", F.lit(GONE_TICKER)))


# The tickers of a batch in which there is news.
LIVELY = ("1-URGENT", "3-MEDIUM")


def quiet_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with every ticker's bars, of which only some tickers bring news: the others repeat the table."""
    lively = F.col("ticker").isin(*LIVELY)
    return upsert_incoming(spark, sf_dir).where(lively).unionByName(upsert_target(spark, sf_dir).where(~lively))
