"""Series features: edge rows, block invariance and partition invariance."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.series import hot_series, previous_value, rolling_mean, series_features
from tidemark.sources import fixtures

from sf_tables import SF01

SCHEMA = "sensor_id string, reading_date date, location string, parameter string, value double, status string, seq long"


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def d(day):
    return dt.date(2024, 1, 1) + dt.timedelta(days=day)


def by_seq(df):
    return {r["seq"]: r for r in df.collect()}


@pytest.fixture(params=[0, 1 << 22], ids=["blocked", "plain"])
def hot(request):
    return request.param


def test_single_reading_has_no_history(spark, hot):
    out = by_seq(series_features(readings(spark, [("0000001", d(0), "X", "p", 5.0, "Good", 1)]), hot_rows=hot))
    r = out[1]
    assert r.reading_no == 1 and r.prev_value is None and r.delta is None and r.z_score is None
    assert r.rolling_avg_7d == 5.0 and r.bad_so_far == 0


def test_constant_series_has_null_z(spark, hot):
    rows = [("0000001", d(i), "X", "p", 3.0, "Good", i) for i in range(3)]
    out = by_seq(series_features(readings(spark, rows), hot_rows=hot))
    assert all(r.z_score is None for r in out.values())
    assert [out[i].delta for i in range(3)] == [None, 0.0, 0.0]


def test_rolling_counts_calendar_days_not_rows(spark, hot):
    rows = [("0000001", d(0), "X", "p", 10.0, "Good", 1), ("0000001", d(7), "X", "p", 20.0, "Good", 2)]
    out = by_seq(series_features(readings(spark, rows), hot_rows=hot))
    assert out[2].rolling_avg_7d == 20.0  # day 0 is 7 days back: outside a 7-day window
    rows[1] = ("0000001", d(6), "X", "p", 20.0, "Good", 2)
    out = by_seq(series_features(readings(spark, rows), hot_rows=hot))
    assert out[2].rolling_avg_7d == 15.0


def test_same_day_peers_share_the_rolling_mean_and_tie_break_by_seq(spark, hot):
    rows = [("0000001", d(0), "X", "p", v, s, q) for v, s, q in
            [(1.0, "Good", 30), (2.0, "Bad", 10), (4.0, "Good", 20)]]
    out = by_seq(series_features(readings(spark, rows), hot_rows=hot))
    assert {r.rolling_avg_7d for r in out.values()} == {2.333}
    assert [out[q].reading_no for q in (10, 20, 30)] == [1, 2, 3]
    assert [out[q].prev_value for q in (10, 20, 30)] == [None, 2.0, 4.0]
    assert [out[q].bad_so_far for q in (10, 20, 30)] == [1, 1, 1]


def plain_windows(df):
    """The obvious per-series window implementation, as a brute-force reference."""
    w = Window.partitionBy("sensor_id", "parameter").orderBy("reading_date", "seq")
    return df.select(
        "seq",
        F.row_number().over(w).alias("reading_no"),
        F.lag("value").over(w).alias("prev_value"),
        F.sum((F.col("status") == "Bad").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("bad_so_far"),
    )


@pytest.mark.parametrize("block_rows,hot_rows", [(1, 0), (3, 0), (64, 0), (1 << 20, 0), (2, 14), (1, 20)])
def test_blocks_and_routing_do_not_change_results(spark, block_rows, hot_rows):
    """hot_rows=0 blocks every series; 14 and 20 split the series between both paths."""
    src = fixtures.readings(spark, SF01)
    plain = series_features(src)
    other = series_features(src, block_rows=block_rows, hot_rows=hot_rows)
    assert plain.count() == other.count() == 10_000
    assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0


def test_hot_series_are_found(spark):
    src = fixtures.readings_with_nulls(spark, SF01)
    keys = ["sensor_id", "parameter"]
    sizes = src.groupBy(*keys).count()
    assert hot_series(src, keys, 14).count() == sizes.where("count > 14").count() > 0
    assert hot_series(src, keys, 14).where("sensor_id IS NULL").count() > 0
    assert hot_series(src, keys, 100_000) is None
    # The bound grows with the table, so that the number of hot series cannot.
    assert hot_series(src, keys, 14, max_keys=300).count() == sizes.where(f"count > {-(-10_000 // 300)}").count()


def test_null_keys_are_kept_on_every_route(spark):
    rows = [(None if k % 3 == 0 else "0000001", d(k // 4), "X", None if k % 5 == 0 else "p", float(k), "Bad" if k % 2 else "Good", k) for k in range(40)]
    df = readings(spark, rows)
    plain = series_features(df, hot_rows=1 << 22)
    assert plain.count() == 40
    for hot_rows in (0, 6):
        other = series_features(df, hot_rows=hot_rows, block_rows=3)
        assert other.count() == 40
        assert plain.exceptAll(other).count() == 0 and other.exceptAll(plain).count() == 0
    lagged = previous_value(df, ["sensor_id"], "seq", "value", hot_rows=1 << 22)
    for hot_rows in (0, 20):
        other = previous_value(df, ["sensor_id"], "seq", "value", block_rows=3, hot_rows=hot_rows)
        assert lagged.exceptAll(other).count() == 0 and other.count() == 40


@pytest.mark.parametrize("hot_rows", [0, 1 << 22])
def test_matches_plain_windows(spark, hot_rows):
    src = fixtures.readings(spark, SF01)
    ours = series_features(src, block_rows=5, hot_rows=hot_rows).select("seq", "reading_no", "prev_value", "bad_so_far")
    ref = plain_windows(src)
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


@pytest.mark.parametrize("parts,hot_rows", [(1, 0), (4, 0), (16, 0), (1, 1 << 22), (16, 1 << 22)])
def test_partitioning_does_not_change_results(spark, parts, hot_rows):
    src = fixtures.readings(spark, SF01)
    base = series_features(src)
    shuffled = series_features(src.repartition(parts, F.rand(seed=parts)), hot_rows=hot_rows)
    assert base.exceptAll(shuffled).count() == 0


def test_rolling_mean_table_agrees_with_feature_column(spark):
    src = fixtures.readings(spark, SF01)
    f = series_features(src)
    exp = rolling_mean(src)
    j = f.join(exp, ["sensor_id", "parameter", "reading_date"])
    assert j.where(F.col("rolling_avg_7d") != F.col("expected")).count() == 0
    assert j.count() == f.count()


@pytest.mark.parametrize("block_rows,hot_rows", [(1, 0), (2, 0), (1000, 0), (2, 66), (1, 1 << 22)])
def test_previous_value_matches_lag(spark, block_rows, hot_rows):
    df = spark.range(0, 200).select(
        (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 200).alias("o"), (F.col("id") * 1.5).alias("v"))
    ours = previous_value(df, ["k"], "o", "v", block_rows=block_rows, hot_rows=hot_rows)
    ref = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("o")))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_a_series_holding_a_third_of_the_rows(spark):
    """One hot series (a third of all rows, many per day) routed to the blocked path."""
    src = fixtures.readings(spark, SF01)
    hot = src.select(F.lit("hotspot").alias("sensor_id"), "reading_date", "location", F.lit("click").alias("parameter"),
                     "value", "status", (F.col("seq") + 1_000_000).alias("seq"))
    hot = hot.unionByName(hot.withColumn("seq", F.col("seq") + 100_000)).limit(5_000)
    skewed = src.unionByName(hot)
    routed = series_features(skewed, block_rows=64, hot_rows=1_000)
    plain = series_features(skewed)
    assert routed.count() == 15_000
    assert routed.exceptAll(plain).count() == 0 and plain.exceptAll(routed).count() == 0


def test_null_values_are_skipped_by_the_statistics(spark, hot):
    rows = [("0000001", d(0), "X", "p", 1.0, "Good", 1), ("0000001", d(1), "X", "p", None, "Good", 2),
            ("0000001", d(2), "X", "p", 3.0, "Good", 3)]
    out = by_seq(series_features(readings(spark, rows), hot_rows=hot))
    assert [out[i].reading_no for i in (1, 2, 3)] == [1, 2, 3]
    assert out[3].prev_value is None and out[3].delta is None
    assert out[3].rolling_avg_7d == 2.0 and out[2].rolling_avg_7d == 1.0
    assert out[1].z_score == -0.707 and out[2].z_score is None


def test_routing_bounds_come_from_the_session(spark):
    src = fixtures.readings(spark, SF01)
    try:
        spark.conf.set("tidemark.hotRows", "14")
        spark.conf.set("tidemark.blockRows", "2")
        via_conf = series_features(src)
    finally:
        spark.conf.unset("tidemark.hotRows")
        spark.conf.unset("tidemark.blockRows")
    plan = via_conf._jdf.queryExecution().analyzed().toString()
    assert "_blk" in plan  # the hot series took the blocked path
    plain = series_features(src)
    assert via_conf.exceptAll(plain).count() == 0 and plain.exceptAll(via_conf).count() == 0


def test_null_ties_and_dates_are_kept_on_both_paths(spark):
    rows = [("0000001", d(0), "X", "p", 1.0, "Good", None), ("0000001", d(0), "X", "p", 2.0, "Good", 5),
            ("0000001", None, "X", "p", 4.0, "Bad", 7), ("0000001", d(1), "X", "p", 3.0, "Good", 9)]
    df = readings(spark, rows)
    plain = series_features(df, hot_rows=1 << 22)
    blocked = series_features(df, hot_rows=0, block_rows=2)
    assert plain.count() == blocked.count() == 4
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_a_non_integer_tie_is_refused(spark):
    df = readings(spark, [("0000001", d(0), "X", "p", 1.0, "Good", 1)]).withColumn("seq", F.col("seq").cast("string"))
    with pytest.raises(TypeError):
        series_features(df)
