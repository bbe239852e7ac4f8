"""Keyed upsert, fingerprints and staleness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources import fixtures

from sf_tables import SF01

KEY = ["date", "ticker"]
VALUES = ["open", "high", "low", "close", "volume", "dividends", "stock_splits"]


def test_fixture_upsert_counts(spark):
    c = merge.classify_upsert(fixtures.upsert_target(spark, SF01), fixtures.upsert_incoming(spark, SF01), KEY, VALUES)
    rep = merge.load_report(c).first()
    assert (rep.inserted, rep.updated, rep.unchanged, rep.retained) == (1101, 580, 5870, 525)


def test_second_run_changes_nothing(spark, tmp_out):
    target, incoming = fixtures.upsert_target(spark, SF01), fixtures.upsert_incoming(spark, SF01)
    snap, _ = merge.upsert(target, incoming, KEY, VALUES)
    path = merge.write_snapshot(snap, tmp_out, 1)
    again, rep = merge.upsert(spark.read.parquet(path), incoming, KEY, VALUES)
    merge.write_snapshot(again, tmp_out, 2)
    r = rep.get  # counted during the write
    assert (r["inserted"], r["updated"]) == (0, 0) and r["unchanged"] == incoming.count()
    with pytest.raises(Exception):
        merge.write_snapshot(snap, tmp_out, 1)  # never overwrite a snapshot


def test_null_equals_null_but_differs_from_value(spark):
    schema = "k int, v double"
    t = spark.createDataFrame([(1, None), (2, None), (3, 1.0)], schema)
    i = spark.createDataFrame([(1, None), (2, 5.0), (4, 2.0)], schema)
    acts = {r.k: r.action for r in merge.classify_upsert(t, i, ["k"], ["v"]).collect()}
    assert acts == {1: "unchanged", 2: "updated", 3: "retained", 4: "inserted"}


def test_duplicate_incoming_key_is_an_error(spark):
    t = spark.createDataFrame([(1, 1.0)], "k int, v double")
    i = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(t, i, ["k"], ["v"])


def test_fingerprint_ignores_row_order_and_partitioning(spark):
    df = fixtures.ohlcv(spark, SF01)
    a = merge.fingerprint(df, ["ticker"])
    b = merge.fingerprint(df.repartition(7, F.rand(seed=1)), ["ticker"])
    assert a.exceptAll(b).count() == 0
    changed = merge.changed_groups(merge.fingerprint(df.where("ticker <> '2-HIGH' OR volume < 3"), ["ticker"]), a, ["ticker"])
    assert {r.ticker for r in changed.where("changed").collect()} == {"2-HIGH"}


def test_stale_inputs_reasons(spark):
    today = dt.date(2024, 5, 1)
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "input string")
    manifest = spark.createDataFrame([
        ("A", today, "5y", "1d"), ("B", dt.date(2024, 4, 30), "5y", "1d"), ("C", today, "1y", "1d"),
    ], "input string, fetched_on date, period string, interval string")
    got = {r.input: (r.stale, r.reason) for r in merge.stale_inputs(wanted, manifest, today, "5y", "1d").collect()}
    assert got == {"A": (False, None), "B": (True, "old"), "C": (True, "different_request"), "D": (True, "missing")}
    forced = merge.stale_inputs(wanted, manifest, today, "5y", "1d", force=True)
    assert forced.where("stale").count() == 4


def test_missing_inputs_raise_with_names(spark):
    wanted = spark.createDataFrame([("A",), ("B",)], "input string")
    have = spark.createDataFrame([("A",)], "input string")
    with pytest.raises(FileNotFoundError, match="B"):
        merge.require_inputs(wanted, have)


def test_both_strategies_classify_alike(spark):
    t, i = fixtures.upsert_target(spark, SF01), fixtures.upsert_incoming(spark, SF01)
    shuffled = merge.classify_upsert(t, i, KEY, VALUES).select(*KEY, "action", *[f"_i_{v}" for v in VALUES])
    broadcast = merge.classify_upsert(t, i, KEY, VALUES, broadcast_bytes=1 << 30)
    broadcast = broadcast.select(*KEY, "action", *[f"_i_{v}" for v in VALUES])
    assert shuffled.count() == broadcast.count()
    assert shuffled.exceptAll(broadcast).count() == 0 and broadcast.exceptAll(shuffled).count() == 0
    plan = merge.classify_upsert(t, i, KEY, VALUES, broadcast_bytes=1 << 30)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_a_large_batch_falls_back_to_the_shuffle(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    i = spark.createDataFrame([(2, 3.0), (3, 4.0)], "k int, v double")
    acts = {r.k: r.action for r in merge.classify_upsert(t, i, ["k"], ["v"], broadcast_bytes=1).collect()}
    assert acts == {1: "retained", 2: "updated", 3: "inserted"}


def test_null_keys_and_one_scan_of_each_side(spark, tmp_out):
    schema = "k int, v double"
    t = spark.createDataFrame([(None, 1.0), (2, 2.0)], schema)
    i = spark.createDataFrame([(None, 3.0), (4, 4.0)], schema)
    for limit in (None, 1 << 20):
        acts = {r.k: r.action for r in merge.classify_upsert(t, i, ["k"], ["v"], broadcast_bytes=limit).collect()}
        assert acts == {None: "updated", 2: "retained", 4: "inserted"}
    for name, df in (("t", t), ("i", i)):
        df.write.parquet(f"{tmp_out}/{name}")
    read = [spark.read.parquet(f"{tmp_out}/{n}") for n in "ti"]
    plan = merge.classify_upsert(*read, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_fingerprints_tell_close_values_and_columns_apart(spark):
    schema = "g int, a string, b string, v double"
    rows = [(1, "a|b", "c", 1.0000001), (2, "a", "b|c", 1.0000002), (3, "a", "b|c", float("nan")), (4, None, "N", float("inf")), (5, "N", None, 1e300)]
    marks = merge.fingerprint(spark.createDataFrame(rows, schema), ["g"]).collect()
    assert len({r.hash_sum for r in marks}) == 5
    near = [(k, "x", "y", v) for k, v in enumerate((1e-20, 2e-20, 5e-324, 0.1 + 0.2, 0.3, 1e300, 1.0000000000000002e300))]
    assert len({r.hash_sum for r in merge.fingerprint(spark.createDataFrame(near, schema), ["g"]).collect()}) == len(near)
    zeros = merge.fingerprint(spark.createDataFrame([(1, "x", "y", 0.0), (2, "x", "y", -0.0)], schema), ["g"]).collect()
    assert len({r.hash_sum for r in zeros}) == 1


def test_changed_groups_see_every_change(spark):
    schema = "g string, v int"
    old = merge.fingerprint(spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), (None, 1)], schema), ["g"])
    new = merge.fingerprint(spark.createDataFrame([("a", 1), ("b", 2), ("d", 1), (None, 1)], schema), ["g"])
    got = {r.g: (r.status, r.changed) for r in merge.changed_groups(new, old, ["g"]).collect()}
    assert got == {"a": ("unchanged", False), "b": ("changed", True), "c": ("removed", True), "d": ("added", True), None: ("unchanged", False)}
    assert all(r.changed for r in merge.changed_groups(new, old, ["g"], force=True).collect())


def test_a_half_written_snapshot_is_neither_read_nor_in_the_way(spark, tmp_out):
    import os
    from tidemark.plans.bars_chain import latest_version
    assert merge.snapshot_versions(spark, f"{tmp_out}/none") == {}
    merge.write_snapshot(spark.createDataFrame([(1,)], "k int"), tmp_out, 0)
    os.makedirs(f"{tmp_out}/v=1/_temporary")
    os.makedirs(f"{tmp_out}/v=2")
    assert merge.snapshot_versions(spark, tmp_out) == {0: True, 1: False, 2: False}
    assert latest_version(spark, tmp_out) == 0
