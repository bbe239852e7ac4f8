"""Registered source queries: scan, table renames and the synthetic generator.

The generator's draws use Spark's xxhash64, which DuckDB does not offer, so its
rows have no oracle; ``synthetic_contract`` counts what they must never do, and
tests/test_synth.py looks at their distributions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.operators.joins import keyed_join
from tidemark.plans.catalog import ORACLES, register
from tidemark.plans.sensor_chain import sensor_chain
from tidemark.plans.sensor_queries import LOCATION_PROFILE_SQL, PARAMETERS
from tidemark.plans.sql_fixtures import RAW_BARS, READINGS, with_
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fixtures, io, synth
from tidemark.sources.tables import table


def _synthetic(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return synth.readings_from_ids(ids)


@register("synthetic_readings")
def synthetic_readings(spark, sf_dir):
    """One synthetic reading per event id: work grows with the events table."""
    return _synthetic(spark, sf_dir)


@register("synthetic_profile")
def synthetic_profile(spark, sf_dir):
    return profile.group_profile(_synthetic(spark, sf_dir), distinct="approx")


CONTRACT = ("bad_id", "bad_location", "bad_parameter", "bad_status", "bad_day", "long_decimals", "moving_sensors")


@register("synthetic_contract", "SELECT count(*) AS rows, " + ", ".join(f"0::BIGINT AS {c}" for c in CONTRACT) + " FROM events")
def synthetic_contract(spark, sf_dir):
    """Rows of the generator that break its contract: id form, domains, dates, decimals, one place per sensor."""
    r = _synthetic(spark, sf_dir)
    last = F.date_add(F.lit(synth.DEFAULT_START), synth.DEFAULT_DAYS - 1)
    broken = {
        "bad_id": ~F.col("sensor_id").rlike("^[0-9a-z]{7}$"),
        "bad_location": ~F.col("location").isin(*synth.LOCATIONS),
        "bad_parameter": ~F.col("parameter").isin(*synth.PARAMETER_MEANS),
        "bad_status": ~F.col("status").isin("Good", "Bad"),
        "bad_day": ~F.col("reading_date").between(F.lit(synth.DEFAULT_START), last),
        "long_decimals": F.col("value") != F.round("value", 3),
    }
    places = r.groupBy("sensor_id").agg(F.count_distinct("location").alias("n")).select(F.count_if(F.col("n") > 1)).scalar()
    counts = r.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, c in broken.items()])
    return counts.withColumn("moving_sensors", places)


# Shares of a normal distribution within one spread of its mean and beyond OUTLIER_SIGMA, and how many standard errors a draw may be off.
WITHIN_ONE, BEYOND, ERRORS = 0.682689492, 0.002699796, 5.0
BANDS = ("mean_in_band", "spread_in_band", "shape_in_band", "bad_in_band", "days_in_band")


@register("synthetic_distribution", f"SELECT unnest({list(synth.PARAMETER_MEANS)!r}) AS parameter, " + ", ".join(f"true AS {b}" for b in BANDS))
def synthetic_distribution(spark, sf_dir):
    """Per parameter, whether the draws have the mean, spread, shape and share of Bad readings that the generator states.

    Each figure may be ``ERRORS`` of its standard errors off: the values' mean
    and spread, the share within one spread of the mean, the share of Bad
    readings (outliers and faults), and the mean of the uniform day.
    """
    r = _synthetic(spark, sf_dir)
    of = F.create_map(*[F.lit(x) for k, (mean, spread) in synth.PARAMETER_MEANS.items() for x in (k, F.struct(F.lit(mean).alias("mean"), F.lit(spread).alias("spread")))])
    stated = F.element_at(of, F.col("parameter"))
    z = (F.col("value") - stated["mean"]) / stated["spread"]
    day = F.date_diff("reading_date", F.lit(synth.DEFAULT_START))
    bad = 1 - (1 - BEYOND) * (1 - synth.FAULT_RATE)
    n = F.col("n").cast("double")
    near = lambda found, want, error: F.abs(found - want) <= ERRORS * error
    found = r.withColumns({"_z": z, "_day": day}).groupBy("parameter").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_z").alias("m"), F.stddev_samp("_z").alias("s"), F.avg(F.when(F.abs("_z") <= 1, 1.0).otherwise(0.0)).alias("one"),
        F.avg(F.when(F.col("status") == "Bad", 1.0).otherwise(0.0)).alias("bad"), F.avg("_day").alias("day"))
    days = synth.DEFAULT_DAYS
    return found.select(
        "parameter",
        near(F.col("m"), 0.0, 1 / F.sqrt(n)).alias("mean_in_band"),
        near(F.col("s"), 1.0, 1 / F.sqrt(2 * n)).alias("spread_in_band"),
        near(F.col("one"), WITHIN_ONE, F.sqrt(WITHIN_ONE * (1 - WITHIN_ONE) / n)).alias("shape_in_band"),
        near(F.col("bad"), bad, F.sqrt(bad * (1 - bad) / n)).alias("bad_in_band"),
        near(F.col("day"), (days - 1) / 2, F.sqrt(F.lit((days**2 - 1) / 12) / n)).alias("days_in_band"),
    )


APPROX_SQL = with_(READINGS) + "SELECT DISTINCT location, parameter, true AS in_band FROM readings"


@register("approx_sensors_in_band", APPROX_SQL)
def approx_sensors_in_band(spark, sf_dir):
    """Whether the sketch's sensor count is within three of its standard errors of the exact one."""
    r = fixtures.readings(spark, sf_dir)
    keys = ["location", "parameter"]
    both = keyed_join(
        profile.group_profile(r, distinct="approx").select(*keys, F.col("sensors").alias("about")),
        profile.count_distinct_by(r, keys, "sensor_id", "exact"), keys)
    return both.select(*keys, (F.abs(F.col("about") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.06)).alias("in_band"))


CHAIN_SQL = with_(READINGS) + """
SELECT unnest(['window', 'aggregate', 'pivot', 'unpivot', 'date_parts']) AS output,
       unnest([(SELECT count(*) FROM readings), (SELECT count(*) FROM (SELECT DISTINCT location, parameter FROM readings)),
               (SELECT count(*) FROM (SELECT DISTINCT sensor_id, reading_date FROM readings)),
               (SELECT count(*) FROM (SELECT DISTINCT sensor_id, reading_date, parameter FROM readings)),
               (SELECT count(*) FROM readings)]) AS rows
"""


@register("chain_outputs", CHAIN_SQL)
def chain_outputs(spark, sf_dir):
    """The five outputs of the chain, written to the shared folder, with the rows of each."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chain-{uuid.uuid4().hex}"
    report = sensor_chain(fixtures.readings(spark, sf_dir), path, PARAMETERS)
    return spark.createDataFrame([(k, v["rows"]) for k, v in report.outputs.items()], "output string, rows bigint")


def _chain_output(name: str):
    def read_back(spark, sf_dir):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chain-{uuid.uuid4().hex}"
        sensor_chain(fixtures.readings(spark, sf_dir), path, PARAMETERS)
        return io.scan(spark, f"{path}/{name}")
    read_back.__name__ = f"chain_{name}"
    read_back.__doc__ = f"A9: the chain's output {name!r}, whole, as it was written."
    return read_back


# The operator of each output has an oracle; the written output must hold the same rows.
# The aggregate's sensor count is a sketch's, so its other measures are compared.
for _name, _same in (("window", "series_features"), ("pivot", "pivot_mean"), ("unpivot", "unpivot_values"), ("date_parts", "date_parts")):
    register(f"chain_{_name}", ORACLES[_same])(_chain_output(_name))


@register("chain_aggregate", f"SELECT * EXCLUDE (sensors) FROM ({LOCATION_PROFILE_SQL})")
def chain_aggregate(spark, sf_dir):
    """The chain's aggregate as it was written, without its approximate sensor count."""
    return _chain_output("aggregate")(spark, sf_dir).drop("sensors")


@register("events_scan", "SELECT * FROM events")
def events_scan(spark, sf_dir):
    return io.scan(spark, f"{str(sf_dir).rstrip('/')}/events.parquet")


RENAMED_SQL = with_(RAW_BARS) + """
SELECT ticker, open, high, low, close, volume,
       CAST(NULL AS DOUBLE) AS dividends, CAST(NULL AS DOUBLE) AS stock_splits, CAST(seq AS BIGINT) AS seq
FROM raw_bars
"""


@register("renamed_for_table", RENAMED_SQL)
def renamed_for_table(spark, sf_dir):
    raw = fixtures.raw_bars(spark, sf_dir).drop("ts", "exchange_tz", "arrival")
    return io.rename_for_table(raw, {"Stock Splits": "stock_splits"})
