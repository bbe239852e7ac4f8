"""Scale properties of every registered query's physical plan.

No cartesian products or nested-loop joins, no Python evaluation in the plan,
no window without a partition key, and the headline shapes (one row exchange
for the series features, one aggregation for the pivot).
"""

import re

import pytest

from tidemark.plans import catalog

from sf_tables import SF001

QUERIES = catalog.load_all()[0]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield {name: physical(q(spark, SF001)) for name, q in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cartesian_or_nested_loop_joins(static_plans):
    bad = {n for n, p in static_plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad, sorted(bad)


def test_no_python_in_any_plan(static_plans):
    markers = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
    bad = {n for n, p in static_plans.items() if any(m in p for m in markers)}
    assert not bad, sorted(bad)


# A window spec without a partition key starts with its sort order (or its frame).
UNPARTITIONED = re.compile(r"windowspecdefinition\((?:[^,()]+ (?:ASC|DESC) NULLS|specifiedwindowframe)")


def test_the_unpartitioned_window_pattern_fires(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(5).select(F.row_number().over(Window.orderBy("id")))
    good = spark.range(5).select(F.row_number().over(Window.partitionBy("id").orderBy("id")))
    assert UNPARTITIONED.search(physical(bad)) and not UNPARTITIONED.search(physical(good))


def test_every_window_is_partitioned(static_plans):
    bad = {n for n, p in static_plans.items() if UNPARTITIONED.search(p)}
    assert not bad, sorted(bad)


def test_series_features_shuffle_the_rows_once(static_plans):
    plan = static_plans["series_features"]
    assert len(re.findall(r"Exchange hashpartitioning\(sensor_id#\d+, parameter#\d+", plan)) == 1
    assert plan.count("Sort [") == 1


def test_pivot_is_one_aggregation(static_plans):
    plan = static_plans["pivot_mean"]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_bar_queries_use_hash_aggregates(static_plans):
    for name in ("bars_clean", "bars_keep_last", "ticker_metrics", "scoreboard"):
        assert "SortAggregate" not in static_plans[name], name
