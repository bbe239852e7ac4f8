"""Sinks, partitioned bar scans, calendar parts and the isolated chain."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.plans.sensor_chain import Step, run_outputs, sensor_chain
from tidemark.plans.sensor_chain import main as sensor_chain_main
from tidemark.sources import fixtures, io, synth

from sf_tables import SF001


def test_write_dataset_reports_rows(spark, tmp_out):
    df = fixtures.readings(spark, SF001)
    rep = io.write_dataset(df, f"{tmp_out}/r", "readings")
    assert rep["rows"] == 1000 and rep["columns"] == df.columns
    assert spark.read.parquet(f"{tmp_out}/r").count() == 1000


def test_scan_bars_takes_ticker_from_partition(spark, tmp_out):
    bars = fixtures.ohlcv(spark, SF001)
    io.write_bars(bars, f"{tmp_out}/bars")
    back = io.scan_bars(spark, f"{tmp_out}/bars", tickers=["2-HIGH"])
    assert back.select("ticker").distinct().collect()[0].ticker == "2-HIGH"
    assert back.count() == bars.where("ticker = '2-HIGH'").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_rename_for_table(spark):
    df = spark.createDataFrame([(1, 2)], "Sensor_ID int, `Date` int")
    assert io.rename_for_table(df, {"Date": "reading_date"}).columns == ["sensor_id", "reading_date"]


def test_iso_week_edge(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2024, 1, 6),)], "d date")
    rows = df.select(*calendar.date_part_columns(F.col("d"), with_iso_year=True)).collect()
    assert (rows[0].week, rows[0].year, rows[0].iso_year) == (1, 2025, 2026)
    assert rows[0].date_label == "2025.12.31" and rows[0].weekday == "Wednesday"
    assert rows[1].is_weekend and rows[1].month_start == dt.date(2024, 1, 1) and rows[1].month_end == dt.date(2024, 1, 31)
    assert rows[0].days_into_year == 364


def test_sensor_chain_writes_five_outputs(spark, tmp_out):
    src = synth.synthetic_readings(spark, 20_000)
    rep = sensor_chain(src, tmp_out, list(synth.PARAMETER_MEANS))
    assert rep.ok and set(rep.outputs) == {"window", "aggregate", "pivot", "unpivot", "date_parts"}
    assert rep.outputs["window"]["rows"] == 20_000 and rep.outputs["aggregate"]["rows"] == 36
    assert rep.outputs["unpivot"]["rows"] == src.select("sensor_id", "reading_date", "parameter").distinct().count()


def test_failed_step_is_isolated_and_dependents_skipped(spark, tmp_out):
    src = synth.synthetic_readings(spark, 100)

    def boom(d):
        raise RuntimeError("broken")

    steps = [Step("a", boom, ("source",)), Step("b", lambda d: d["a"], ("a",)),
             Step("c", lambda d: d["source"], ("source",))]
    rep = run_outputs(steps, tmp_out, {"source": src})
    assert set(rep.failed) == {"a"} and rep.skipped == ["b"] and set(rep.outputs) == {"c"}


def test_chain_job_writes_and_verifies(tmp_out):
    assert sensor_chain_main([f"{tmp_out}/job", "--rows", "30000"]) == 0


def test_conform_orders_casts_and_names_missing(spark):
    from tidemark.operators.bars import conform
    df = spark.createDataFrame([(1, "a", 2.5)], "volume int, ticker string, close double")
    out = conform(df, ["ticker", "close", "volume"], {"volume": "long"})
    assert out.columns == ["ticker", "close", "volume"] and dict(out.dtypes)["volume"] == "bigint"
    import pytest
    with pytest.raises(ValueError, match="open, high"):
        conform(df, ["open", "high", "close"])


def test_bars_chain_twice_changes_nothing(spark, tmp_out):
    from tidemark.plans.bars_chain import bars_chain, latest_version, metrics_view
    raw_path = f"{tmp_out}/raw"
    fixtures.raw_bars(spark, SF001).drop("arrival").write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    first = bars_chain(spark, raw, f"{tmp_out}/snap")
    assert first.version == 0 and first.load["inserted"] == first.load["total"] > 0
    assert {d["rule"] for d in first.dropped} == {"duplicate_date", "incomplete", "nonpositive", "inconsistent"}
    second = bars_chain(spark, raw, f"{tmp_out}/snap")
    assert second.version == 1 and latest_version(spark, f"{tmp_out}/snap") == 1
    assert (second.load["inserted"], second.load["updated"]) == (0, 0)
    assert second.load["unchanged"] == first.load["inserted"]
    m = metrics_view(spark, second.snapshot)
    assert m.count() == first.load["total"] and m.where("drawdown_pct > 0").count() == 0


def test_dataset_read_back_writes_no_single_file(spark, monkeypatch):
    from tidemark.plans import bars_queries
    made, write = [], io.write_dataset
    monkeypatch.setattr(bars_queries, "FILE_ROWS", 50)
    monkeypatch.setattr(io, "write_dataset", lambda df, path, *a, **k: made.append(path) or write(df, path, *a, **k))
    rows = bars_queries.dataset_read_back(spark, SF001).collect()
    sizes = [r["count"] for r in spark.read.parquet(made[0]).groupBy("_metadata.file_path").count().collect()]
    assert len(rows) == sum(sizes) == rows[0].reported and len(sizes) > 1 and max(sizes) <= 50


def test_single_file_of_a_small_output(spark, tmp_out):
    io.write_dataset(spark.range(100).repartition(4), f"{tmp_out}/one", single_file=True)
    assert spark.read.parquet(f"{tmp_out}/one").select("_metadata.file_path").distinct().count() == 1


def test_bars_chain_writes_the_whole_report(spark, tmp_out, monkeypatch):
    from tidemark.operators import bars
    from tidemark.plans import bars_chain
    monkeypatch.setattr(bars_chain, "REPORTED", 2)
    fixtures.raw_bars(spark, SF001).drop("arrival").write.parquet(f"{tmp_out}/raw")
    raw = spark.read.parquet(f"{tmp_out}/raw")
    run = bars_chain.bars_chain(spark, raw, f"{tmp_out}/snap")
    whole = {tuple(r) for r in bars.report_from(bars.annotate_repairs(bars.normalize(raw))).select("ticker", "rule", "dropped").collect()}
    written = [tuple(r) for r in spark.read.parquet(run.report).select("ticker", "rule", "dropped").collect()]
    assert set(written) == whole and len(written) == len(whole) == run.report_lines > len(run.dropped) == 2
    assert bars_chain.latest_version(spark, f"{tmp_out}/snap") == 0


def test_bars_chain_stops_on_dates_out_of_order(spark, tmp_out):
    import os
    import pytest
    from tidemark.plans.bars_chain import ValidationFailed, bars_chain
    with pytest.raises(ValidationFailed, match="out of order"):
        bars_chain(spark, fixtures.raw_bars(spark, SF001), f"{tmp_out}/snap", arrival="arrival")
    assert not os.path.exists(f"{tmp_out}/snap")


def test_bars_chain_refuses_a_missing_ticker(spark, tmp_out):
    import pytest
    from tidemark.plans.bars_chain import ValidationFailed, bars_chain
    raw = fixtures.raw_bars(spark, SF001).drop("arrival")
    with pytest.raises(ValidationFailed, match="NOPE"):
        bars_chain(spark, raw, f"{tmp_out}/snap", wanted=["1-URGENT", "NOPE"])
