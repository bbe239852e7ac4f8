"""Versioned tables, partial loads and rebuilds by manifest."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge, versions
from tidemark.operators.versions import VersionedTable
from tidemark.plans import bars_chain
from tidemark.sources import fixtures

from sf_tables import SF001

COLUMNS = "date date, ticker string, close double"
KEY, VALUES = ["date", "ticker"], ["close"]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def bars(spark, rows):
    return spark.createDataFrame([(day(n), t, c) for n, t, c in rows], COLUMNS)


def content(df):
    return sorted(((r.date, r.ticker, r.close) for r in df.collect()), key=str)


def folders(base):
    """Every file below a folder."""
    return sorted(os.path.join(d, f) for d, _, files in os.walk(base) for f in files)


def test_a_load_writes_only_groups_with_news(spark, tmp_out):
    table = VersionedTable(spark, tmp_out, COLUMNS, "ticker", "date")
    assert table.version() is None and table.read().count() == 0
    first = table.load(bars(spark, [(n, t, 1.0) for n in range(3) for t in ("A", "B", None, "")]), KEY, VALUES)
    assert (first["inserted"], first["version"], first["groups_written"]) == (12, 0, 4)
    report = table.load(bars(spark, [(0, "A", 1.0), (1, "B", 5.0), (9, None, 2.0)]), KEY, VALUES)
    assert {k: report[k] for k in ("inserted", "updated", "unchanged", "retained", "total", "version", "groups_read", "groups_written")} == {
        "inserted": 1, "updated": 1, "unchanged": 1, "retained": 10, "total": 13, "version": 1, "groups_read": 3, "groups_written": 2}
    assert (report["first_date"], report["last_date"]) == (day(0), day(9))
    assert {r.ticker: r.written for r in table.lines().collect()} == {"A": 0, "": 0, "B": 1, None: 1}
    assert len(os.listdir(f"{tmp_out}/data/v=1")) == len({"B", None}) + 2  # and _SUCCESS with its checksum
    assert table.read().count() == 13 and content(table.read(version=0)) == content(bars(spark, [(n, t, 1.0) for n in range(3) for t in ("A", "B", None, "")]))
    assert content(table.read(groups=spark.createDataFrame([(None,), ("",)], "ticker string"))) == content(
        bars(spark, [(n, t, 1.0) for n in range(3) for t in (None, "")] + [(9, None, 2.0)]))


def test_nothing_new_writes_nothing(spark, tmp_out):
    table = VersionedTable(spark, tmp_out, COLUMNS, "ticker", "date")
    rows = bars(spark, [(0, "A", 1.0), (1, "A", None)])
    table.load(rows, KEY, VALUES)
    before = folders(tmp_out)
    again = table.load(rows, KEY, VALUES)
    assert folders(tmp_out) == before
    assert (again["inserted"], again["updated"], again["unchanged"], again["version"], again["groups_written"]) == (0, 0, 2, 0, 0)


def test_a_load_equals_the_whole_upsert(spark, tmp_out):
    target, incoming = fixtures.upsert_target(spark, SF001), fixtures.quiet_incoming(spark, SF001)
    values = ["open", "high", "low", "close", "volume", "dividends", "stock_splits"]
    table = VersionedTable(spark, tmp_out, bars_chain.OHLCV, "ticker", "date")
    table.load(target, KEY, values)
    report = table.load(incoming, KEY, values)
    whole = merge.classify_upsert(target, incoming, KEY, values)
    want, got = merge.snapshot_from(whole, KEY, values), table.read()
    assert got.select(*KEY, *values).exceptAll(want).count() == 0 and want.exceptAll(got.select(*KEY, *values)).count() == 0
    counts = merge.load_report(whole).first().asDict()
    assert counts == {k: report[k] for k in counts}


def test_a_run_that_died_leaves_the_last_version(spark, tmp_out):
    table = VersionedTable(spark, tmp_out, COLUMNS, "ticker", "date")
    table.load(bars(spark, [(0, "A", 1.0)]), KEY, VALUES)
    os.makedirs(f"{tmp_out}/data/v=1/_group=half")       # rows without a version
    os.makedirs(f"{tmp_out}/versions/v=2")               # lines without _SUCCESS
    assert table.version() == 0
    report = table.load(bars(spark, [(0, "A", 2.0)]), KEY, VALUES)
    assert report["version"] == 3 and content(table.read()) == [(day(0), "A", 2.0)]


def test_a_group_without_rows_is_gone_and_repeats_are_refused(spark, tmp_out):
    table = VersionedTable(spark, tmp_out, COLUMNS, "ticker", "date")
    table.load(bars(spark, [(0, "A", 1.0), (0, "B", 1.0)]), KEY, VALUES)
    table.write_groups(bars(spark, [(5, "A", 3.0)]), spark.createDataFrame([("A",), ("B",)], "ticker string"))
    assert content(table.read()) == [(day(5), "A", 3.0)] and table.lines().count() == 1
    with pytest.raises(merge.DuplicateKeyError):
        table.load(bars(spark, [(0, "A", 1.0), (0, "A", 2.0)]), KEY, VALUES)


def test_a_hot_group_is_written_by_several_tasks(spark, tmp_out):
    table = VersionedTable(spark, tmp_out, "date date, ticker string, close double, note string", "ticker", "date")
    rows = spark.range(60_000).select(
        F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("date"), F.lit("HOT").alias("ticker"), F.rand(1).alias("close"),
        F.sha2(F.col("id").cast("string"), 512).alias("note"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        table.load(rows, KEY, ["close", "note"])
    finally:
        for k in conf:
            spark.conf.unset(k)
    files = [f for f in folders(f"{tmp_out}/data") if f.endswith(".parquet")]
    assert len(files) > 1 and table.read().count() == 60_000


# --- rebuild by manifest ----------------------------------------------------------------

def raw(spark, rows):
    """Raw bars: (ticker, day, close, seq)."""
    full = [(t, "UTC", dt.datetime.combine(day(n), dt.time()), c, c, c, c, 10, None, None, s) for t, n, c, s in rows]
    schema = ("ticker string, exchange_tz string, ts timestamp, Open double, High double, Low double, Close double, Volume bigint, "
              "Dividends double, `Stock Splits` double, seq bigint")
    return spark.createDataFrame(full, schema)


BEFORE = [(t, n, 10.0 + n, 0) for t in ("A", "B", "C") for n in range(4)]


def test_only_what_differs_from_the_manifest_is_redone(spark, tmp_out):
    first = bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "5y/1d")
    assert first.built == ["A", "B", "C"] and first.load["inserted"] == 12
    state = folders(tmp_out)
    idle = bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "5y/1d")
    assert (idle.built, idle.dropped, idle.kept, idle.load) == ([], [], 3, None) and folders(tmp_out) == state

    today = [r for r in BEFORE if r[0] != "C"] + [("B", 1, 99.0, 1)]
    second = bars_chain.bars_rebuild(spark, raw(spark, today), tmp_out, "5y/1d")
    assert (second.built, second.dropped, second.kept) == (["B"], ["C"], 1)
    assert (second.load["inserted"], second.load["updated"], second.load["groups_written"]) == (0, 1, 1)
    clean, loaded, metrics = bars_chain.tables_of(spark, tmp_out)
    assert {r.ticker: r.written for r in clean.lines().collect()} == {"A": 0, "B": 1}
    assert {r.ticker: r.written for r in loaded.lines().collect()} == {"A": 0, "B": 1, "C": 0}  # a load deletes nothing
    assert {r.ticker: r.written for r in metrics.lines().collect()} == {"A": 0, "B": 1, "C": 0}
    assert loaded.read().where("ticker = 'B' AND close = 99").count() == 1
    whole = bars_chain.bars.bar_metrics(loaded.read())
    assert metrics.read().exceptAll(whole).count() == 0 and whole.exceptAll(metrics.read()).count() == 0


def test_another_request_and_force_rebuild(spark, tmp_out):
    bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "5y/1d")
    other = bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "1y/1d")
    assert other.built == ["A", "B", "C"] and other.load["groups_written"] == 0
    forced = bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "1y/1d", force=True)
    assert forced.built == ["A", "B", "C"] and forced.load["unchanged"] == 12


def test_a_run_that_fails_leaves_the_record_and_is_done_again(spark, tmp_out):
    bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "5y/1d")
    state = folders(tmp_out)
    emptied = [r for r in BEFORE if r[0] != "B"] + [("B", n, -1.0, 0) for n in range(4)]
    with pytest.raises(bars_chain.ValidationFailed, match="B"):
        bars_chain.bars_rebuild(spark, raw(spark, emptied), tmp_out, "5y/1d")
    late = raw(spark, BEFORE + [("A", 9, 5.0, 0)]).withColumn("arrival", -F.monotonically_increasing_id())
    with pytest.raises(bars_chain.ValidationFailed, match="out of order"):
        bars_chain.bars_rebuild(spark, late, tmp_out, "5y/1d", arrival="arrival")
    with pytest.raises(FileNotFoundError, match="Z"):
        bars_chain.bars_rebuild(spark, raw(spark, BEFORE), tmp_out, "5y/1d", wanted=["A", "Z"])
    assert folders(tmp_out) == state
    mended = bars_chain.bars_rebuild(spark, raw(spark, BEFORE + [("B", 9, 5.0, 0)]), tmp_out, "5y/1d")
    assert mended.built == ["B"] and mended.load["inserted"] == 1


def test_plan_names_every_state(spark):
    schema = "ticker string, close double"
    now = versions.manifest_of(spark.createDataFrame([("same", 1.0), ("new", 1.0), ("other", 2.0), (None, 1.0), ("asked", 1.0)], schema), "ticker", "r")
    then = versions.manifest_of(spark.createDataFrame([("same", 1.0), ("gone", 1.0), ("other", 1.0), (None, 1.0), ("asked", 1.0)], schema), "ticker", "r")
    then = then.withColumn("request", F.when(F.col("ticker") == "asked", "q").otherwise(F.col("request")))
    got = {r.ticker: (r.status, r.action) for r in versions.rebuild_plan(now, then, "ticker").collect()}
    assert got == {"same": ("unchanged", "keep"), None: ("unchanged", "keep"), "new": ("added", "build"), "gone": ("removed", "drop"),
                   "other": ("changed", "build"), "asked": ("different_request", "build")}
    assert {r.action for r in versions.rebuild_plan(now, then, "ticker", force=True).collect()} == {"build", "drop"}


def test_command_line(spark, tmp_out):
    raw(spark, BEFORE).write.parquet(f"{tmp_out}/raw")
    assert bars_chain.main([f"{tmp_out}/raw", f"{tmp_out}/base", "--incremental", "5y/1d"]) == 0
    assert bars_chain.tables_of(spark, f"{tmp_out}/base")[1].read().count() == 12
    assert bars_chain.main([f"{tmp_out}/raw", f"{tmp_out}/base", "--incremental", "5y/1d", "--tickers", "A,Z"]) == 1
