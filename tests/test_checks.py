"""Mutation tests: break one row, and exactly the matching check must FAIL."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, profile, suite
from tidemark.operators.series import series_features
from tidemark.sources import fixtures
from tidemark.sources.schemas import LOCATION_STATS, READINGS_FEATURES

from sf_tables import SF001


@pytest.fixture(scope="module")
def base(spark):
    r = fixtures.readings(spark, SF001).cache()
    f = series_features(r).cache()
    s = profile.group_profile(r).cache()
    yield r, f, s
    for df in (r, f, s):
        df.unpersist()


def verdicts(readings, feats, summary):
    return {row.check_id: row.verdict for row in checks.run_checks([
        checks.check_arrival(readings, expected_categories=5),
        checks.check_summary(summary, readings),
        checks.check_window(feats),
        checks.check_positions(feats),
        checks.check_rolling(feats),
        checks.check_one_location(readings),
        checks.check_table(feats, READINGS_FEATURES, "readings_constraints"),
        checks.check_table(summary, LOCATION_STATS, "location_stats_constraints"),
    ]).collect()}


def whole(feats, summary):
    """(rows, violations, verdict) per check of the one-pass suite."""
    return {r.check_id: (r.rows_checked, r.violations, r.verdict) for r in suite.sensor_suite(feats, summary, expected_categories=5).collect()}


def one_by_one(feats, summary):
    """The same by the single checks, with the features as the readings."""
    return {r.check_id: (r.rows_checked, r.violations, r.verdict) for r in checks.run_checks([
        checks.check_arrival(feats, expected_categories=5), checks.check_summary(summary, feats), checks.check_window(feats),
        checks.check_positions(feats), checks.check_rolling(feats), checks.check_one_location(feats),
        checks.check_table(feats, READINGS_FEATURES, "readings_constraints"), checks.check_table(summary, LOCATION_STATS, "location_stats_constraints"),
    ]).collect()}


#: What is done to the features, or to the summary.
BROKEN_FEATURES = {
    "nothing": {},
    "position": {"reading_no": "IF(reading_no = 3, 2, reading_no)"},
    "no_position": {"reading_no": "IF(seq % 50 = 0, NULL, reading_no)"},
    "delta": {"delta": "delta + IF(seq % 9 = 0, 0.01, 0)"},
    "no_delta": {"delta": "IF(seq % 9 = 0, NULL, delta)"},
    "previous": {"prev_value": "IF(reading_no = 1, 5.0D, prev_value)"},
    "flags": {"bad_so_far": "IF(seq % 7 = 0, -1, IF(seq % 5 = 0, 99999, bad_so_far))"},
    "rolling": {"rolling_avg_7d": "IF(seq % 7 = 0, NULL, rolling_avg_7d + IF(seq % 5 = 0, 0.001, 0.0004))"},
    "location": {"location": "IF(seq % 11 = 0, 'ELSEWHERE', location)"},
    "nulls": {"sensor_id": "IF(seq % 13 = 0, NULL, sensor_id)", "location": "IF(seq % 17 = 0, NULL, location)", "parameter": "IF(seq % 19 = 0, NULL, parameter)"},
    "status": {"status": "IF(seq % 23 = 0, 'Odd', status)"},
    "category": {"parameter": "IF(parameter = 'error', 'click', parameter)"},
}
BROKEN_SUMMARY = {
    "mean": {"avg_value": "avg_value + 0.01"}, "median": {"median_value": "p95_value"}, "sensors": {"sensors": "sensors + 5"},
    "dates": {"first_reading": "date_add(last_reading, 1)"}, "count": {"readings": "IF(parameter = 'click', 0, readings)"},
    "key": {"location": "IF(location = 'ASIA', NULL, location)"}, "twice": {"location": "IF(location = 'ASIA', 'EUROPE', location)"},
}


@pytest.mark.parametrize("name", BROKEN_FEATURES)
def test_one_pass_equals_the_single_checks_over_broken_features(base, name):
    _, f, s = base
    broken = f.withColumns({c: F.expr(e) for c, e in BROKEN_FEATURES[name].items()}) if BROKEN_FEATURES[name] else f
    got = whole(broken, s)
    assert tuple(sorted(got)) == tuple(sorted(suite.CHECKS)) and got == one_by_one(broken, s)
    assert (name == "nothing") == all(v == "PASS" for *_, v in got.values())


@pytest.mark.parametrize("name", BROKEN_SUMMARY)
def test_one_pass_equals_the_single_checks_over_a_broken_summary(base, name):
    _, f, s = base
    broken = s.withColumns({c: F.expr(e) for c, e in BROKEN_SUMMARY[name].items()})
    got, want = whole(f, broken), one_by_one(f, broken)
    if name == "twice":  # the single check counts each row of a repeated key
        assert got.pop("summary_agrees")[2] == want.pop("summary_agrees")[2] == "FAIL"
    assert got == want and any(v == "FAIL" for *_, v in got.values())


def test_one_pass_over_nothing(base):
    _, f, s = base
    got = whole(f.where("false"), s.where("false"))
    assert got["arrival"] == (0, 2, "FAIL") and all(v == "PASS" for k, (*_, v) in got.items() if k != "arrival")


def test_one_pass_reads_the_features_twice(spark, base, tmp_out):
    _, f, s = base
    f.write.parquet(f"{tmp_out}/f")
    s.write.parquet(f"{tmp_out}/s")
    plan = suite.sensor_suite(spark.read.parquet(f"{tmp_out}/f"), spark.read.parquet(f"{tmp_out}/s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_out}/f") == 2


def failing(readings, feats, summary):
    return {k for k, v in verdicts(readings, feats, summary).items() if v != "PASS"}


def target_seq(feats):
    return feats.where("reading_no = 3").agg(F.min("seq")).first()[0]


def test_clean_data_passes(base):
    assert failing(*base) == set()
    checks.assert_checks(checks.check_window(base[1]))


def test_duplicate_position_fails_positions_and_key(base):
    r, f, s = base
    seq = target_seq(f)
    broken = f.withColumn("reading_no", F.when(F.col("seq") == seq, F.col("reading_no") - 1).otherwise(F.col("reading_no")))
    assert failing(r, broken, s) == {"positions_complete", "readings_constraints"}


def test_wrong_delta_fails_window(base):
    r, f, s = base
    seq = target_seq(f)
    broken = f.withColumn("delta", F.when(F.col("seq") == seq, F.col("delta") + 0.01).otherwise(F.col("delta")))
    assert failing(r, broken, s) == {"window_consistent"}
    with pytest.raises(checks.CheckFailed):
        checks.assert_checks(checks.check_window(broken))


def test_second_location_fails_one_location(base):
    r, f, s = base
    seq = r.agg(F.min("seq")).first()[0]
    broken = r.withColumn("location", F.when(F.col("seq") == seq, F.lit("ELSEWHERE")).otherwise(F.col("location")))
    assert "one_location_per_sensor" in failing(broken, f, s)
    assert checks.check_one_location(broken).first().violations == 1


def test_off_rolling_mean_fails_rolling(base):
    r, f, s = base
    seq = target_seq(f)
    broken = f.withColumn("rolling_avg_7d", F.when(F.col("seq") == seq, F.col("rolling_avg_7d") + 0.001)
                          .otherwise(F.col("rolling_avg_7d")))
    assert failing(r, broken, s) == {"rolling_mean_recomputes"}


def test_half_a_digit_is_agreement(base):
    r, f, s = base
    seq = target_seq(f)
    ok = f.withColumn("rolling_avg_7d", F.when(F.col("seq") == seq, F.col("rolling_avg_7d") + 0.0004)
                      .otherwise(F.col("rolling_avg_7d")))
    assert failing(r, ok, s) == set()


def test_summary_disagreement_fails_summary(base):
    r, f, s = base
    first = s.agg(F.min("parameter")).first()[0]
    broken = s.withColumn("avg_value", F.when(F.col("parameter") == first, F.col("avg_value") + 0.01)
                          .otherwise(F.col("avg_value")))
    assert failing(r, f, broken) == {"summary_agrees"}
    missing = s.where(F.col("parameter") != first)
    assert failing(r, f, missing) == {"summary_agrees"}


def test_null_value_fails_arrival(base):
    r, f, s = base
    seq = r.agg(F.min("seq")).first()[0]
    broken = r.withColumn("status", F.when(F.col("seq") == seq, F.lit(None)).otherwise(F.col("status")))
    assert checks.check_arrival(broken, expected_categories=5).first().verdict == "FAIL"
    assert checks.check_arrival(r, expected_categories=6).first().verdict == "FAIL"


def test_constraints_report_each_violation(spark, base):
    r, f, s = base
    seq = target_seq(f)
    broken = f.withColumn("bad_so_far", F.when(F.col("seq") == seq, F.lit(-1)).otherwise(F.col("bad_so_far"))) \
        .withColumn("delta", F.when(F.col("seq") == seq, F.lit(None)).otherwise(F.col("delta")))
    v = {row.constraint: row.violations for row in checks.check_constraints(broken, READINGS_FEATURES).collect()}
    assert v["bad_so_far is at least 0"] == 1 and v["prev_value and delta are set together"] == 1
    assert v["key sensor_id, parameter, reading_no"] == 0 and v["status is set"] == 0


def test_side_by_side_counts(base):
    r, f, s = base
    row = checks.side_by_side_counts(readings=r, summaries=s).first()
    assert row.readings == 1000 and row.summaries == 25


def test_approximate_sensor_count_is_within_its_band(spark):
    r = fixtures.readings(spark, SF001)
    exact = {(x.location, x.parameter): x.sensors for x in profile.group_profile(r).collect()}
    approx = {(x.location, x.parameter): x.sensors for x in profile.group_profile(r, distinct="approx").collect()}
    assert exact.keys() == approx.keys()
    for k, v in exact.items():
        assert abs(approx[k] - v) <= max(1, 0.06 * v)


def test_a_median_off_by_many_ranks_fails_summary(base):
    r, f, s = base
    first = s.agg(F.min("parameter")).first()[0]
    broken = s.withColumn("median_value", F.when(F.col("parameter") == first, F.col("p95_value"))
                          .otherwise(F.col("median_value")))
    assert failing(r, f, broken) == {"summary_agrees"}


def test_a_wrong_sensor_count_fails_summary(base):
    r, f, s = base
    broken = s.withColumn("sensors", F.col("sensors") + 5)
    assert failing(r, f, broken) == {"summary_agrees"}


def test_the_approximate_summary_passes(spark, base):
    r, f, s = base
    approx = profile.group_profile(r, distinct="approx")
    assert checks.check_summary(approx, r).first().verdict == "PASS"


@pytest.mark.parametrize("rounds,ties", [(0, False), (1, False), (1, True), (2, False), (3, True)])
def test_exact_quantiles_match_sorted_ranks(spark, rounds, ties):
    import math
    from decimal import Decimal
    r = fixtures.readings(spark, "/root/testdata/sf0.01")
    if ties:
        r = r.withColumn("value", F.floor(F.col("value") / 50).cast("double"))
    probs = {"q05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95, "top": 1.0}
    got = {row.parameter: row for row in profile.exact_quantiles(r, ["parameter"], "value", probs, rounds).collect()}
    values = {}
    for row in r.select("parameter", "value").collect():
        values.setdefault(row.parameter, []).append(row.value)
    for param, vs in values.items():
        vs.sort()
        for name, p in probs.items():
            rank = max(1, math.ceil(Decimal(repr(p)) * len(vs)))
            assert got[param][name] == vs[rank - 1], (param, name)


def test_null_groups_agree_with_their_summary(spark):
    r = fixtures.readings_with_nulls(spark, SF001)
    for quantiles in ("approx", "exact"):
        s = profile.group_profile(r, quantiles=quantiles)
        assert s.where("location IS NULL AND sensors = 0").count() == 0
        assert s.where("median_value IS NULL").count() == 0
        assert checks.check_summary(s, r).first().verdict == "PASS"


@pytest.mark.parametrize("grid,k", [(4, 8), (16, 8), (1024, 8192)])
def test_exact_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch, grid, k):
    """A coarse sketch misses ranks: more rows go on, the result is the same."""
    monkeypatch.setattr(profile, "GRID", grid)
    monkeypatch.setattr(profile, "SKETCH_K", k)
    monkeypatch.setattr(profile, "MARGIN", 0)
    r = fixtures.readings_with_nulls(spark, SF001)
    got = {x.parameter: x.m for x in profile.exact_quantiles(r, ["parameter"], "value", {"m": 0.5}).collect()}
    values = {}
    for x in r.collect():
        values.setdefault(x.parameter, []).append(x.value)
    assert got == {k: sorted(v)[(len(v) + 1) // 2 - 1] for k, v in values.items()}


def test_crowded_values_do_not_meet_in_one_task(spark):
    """All values but a few lie in one millionth of the range; each round still leaves a small share of them."""
    rows = spark.range(200_000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") < 4, F.col("id") * 1e12).otherwise(
        F.lit(5.0) + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(1e12)).alias("v")).cache()
    plan = profile.exact_quantiles(rows, ["k"], "v", {"q1": 0.25, "m": 0.5})
    walked = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in x]
    assert len(walked) == 1
    got = {r.k: (r.q1, r.m) for r in plan.collect()}
    for k in (0, 1):
        vs = sorted(r.v for r in rows.where(F.col("k") == k).collect())
        assert got[k] == (vs[24_999], vs[49_999])
    band = rows.where("k = 0").select("k", F.lit(0).alias("_i"), F.col("v").alias("_value"), F.col("v").alias("_x"), F.lit(50_000).cast("long").alias("_rank"))
    at = ["k", "_i"]
    for share in (100, 2_000):
        inner = band.groupBy(*at).agg(profile._grid("_x").alias("_grid"), F.count(F.lit(1)).alias("_n"), F.first("_rank").alias("_r"))
        brackets = inner.select(*at, *profile._bracket(F.col("_r"), F.col("_n"), "_grid")).checkpoint()
        band = profile._narrowed(profile.keyed_join(band, brackets, at), at).checkpoint()
        assert band.count() <= max(100_000 / share, 50)
    rows.unpersist()


def test_exact_quantiles_put_nan_above_all(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("a", nan), ("b", nan), ("c", None), ("d", float("inf")), ("d", -1.0), (None, 2.0)], "k string, v double")
    got = {r.k: (r.lo, r.hi) for r in profile.exact_quantiles(df, ["k"], "v", {"lo": 0.1, "hi": 0.9}).collect()}
    assert got["a"][0] == 1.0 and got["a"][1] != got["a"][1] and got["b"][0] != got["b"][0]
    assert got["d"] == (-1.0, float("inf")) and got[None] == (2.0, 2.0) and "c" not in got
