"""Bars: one table of raw rows against every rule, exchange dates, fixture counts, metrics."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, checks
from tidemark.sources import fixtures

from sf_tables import SF01

NAN = float("nan")
COLUMNS = "ticker string, date date, seq long, open double, high double, low double, close double, volume long, dividends double, stock_splits double"

# (ticker, day, seq, open, high, low, close, volume), and the rule that takes the row out (None: it stays).
RAW = [
    ("kept", 1, 0, 20.0, 24.0, 19.0, 21.5, 700, None),
    ("kept", 2, 0, 21.5, 21.5, 21.5, 21.5, None, None),       # flat, no volume
    ("again", 1, 0, 5.0, 6.0, 4.0, 5.5, 10, "duplicate_date"),
    ("again", 1, 1, 5.0, 6.0, 4.0, 4.5, 11, None),            # arrived later
    ("again", 2, 7, 5.0, 6.0, 4.0, 5.0, 12, "duplicate_date"),
    ("again", 2, 9, 5.0, 6.0, 4.0, None, 13, "incomplete"),   # the later one is bad: the date goes
    ("gaps", 1, 0, None, 6.0, 4.0, 5.0, 1, "incomplete"),
    ("gaps", 2, 0, 5.0, NAN, 4.0, 5.0, 1, "incomplete"),
    ("gaps", 3, 0, 5.0, 6.0, 4.0, NAN, 1, "incomplete"),
    ("free", 1, 0, 5.0, 6.0, 0.0, 5.0, 1, "nonpositive"),
    ("free", 2, 0, -1.0, 6.0, -2.0, 5.0, 1, "nonpositive"),
    ("torn", 1, 0, 5.0, 5.5, 4.0, 5.75, 1, "inconsistent"),   # close above the high
    ("torn", 2, 0, 3.5, 6.0, 4.0, 5.0, 1, "inconsistent"),    # open below the low
    (None, 1, 0, 5.0, 6.0, 4.0, 5.0, 1, None),                # no ticker: a group like any other
]


def day(n):
    return dt.date(2021, 3, n)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(t, day(d), s, o, h, lo, c, v, None, NAN) for t, d, s, o, h, lo, c, v, _ in RAW], COLUMNS)


def test_repair_keeps_and_reports_each_row(raw):
    clean, report = bars.repair(raw)
    stays = {(t, day(d), c): v or 0 for t, d, _, _, _, _, c, v, rule in RAW if rule is None}
    assert {(r.ticker, r.date, r.close): r.volume for r in clean.collect()} == stays
    assert all((r.dividends, r.stock_splits) == (0.0, 0.0) for r in clean.collect())
    dropped = {}
    for row in RAW:
        if row[-1]:
            dropped[row[0], row[-1]] = dropped.get((row[0], row[-1]), 0) + 1
    assert {(r.ticker, r.rule): r.dropped for r in report.collect() if r.dropped} == dropped


@pytest.mark.parametrize("rule, operator", [
    ("incomplete", bars.drop_incomplete), ("nonpositive", bars.drop_nonpositive), ("inconsistent", bars.drop_inconsistent),
])
def test_each_rule_alone_takes_its_rows(raw, rule, operator):
    whole = raw.where("NOT (isnull(open) OR isnan(open) OR isnull(high) OR isnan(high) OR isnull(close) OR isnan(close))")
    source = raw if rule == "incomplete" else whole
    gone = source.exceptAll(operator(source)).collect()
    expected = {(t, day(d), s) for t, d, s, *_, r in RAW if r == rule}
    # A bar with a price of nothing is out of its bracket only where the rule says so.
    assert expected <= {(r.ticker, r.date, r.seq) for r in gone}
    assert all(r.ticker not in ("kept", None) for r in gone)


def test_names_become_snake_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Adj Close` int, VOLUME int, `Stock Splits` int")
    assert bars.snake_case(df).columns == ["adj_close", "volume", "stock_splits"]


@pytest.mark.parametrize("zone, instant, local", [
    ("America/New_York", "2021-07-02 02:30:00+00:00", day(1).replace(month=7, day=1)),
    ("Asia/Tokyo", "2021-07-01 15:00:00+00:00", day(1).replace(month=7, day=2)),
    ("UTC", "2021-07-01 23:59:59+00:00", day(1).replace(month=7, day=1)),
])
def test_the_date_is_the_exchange_s(spark, zone, instant, local):
    df = spark.createDataFrame([("T", zone, instant)], "ticker string, exchange_tz string, text string")
    assert bars.normalize(df.select("ticker", "exchange_tz", F.to_timestamp("text").alias("ts"))).first().date == local


def test_tokyo_midnight_keeps_its_local_date(spark):
    df = spark.createDataFrame([("T", "Asia/Tokyo")], "ticker string, exchange_tz string").select(
        "ticker", "exchange_tz", F.make_timestamp(F.lit(2024), F.lit(1), F.lit(2), F.lit(0), F.lit(0), F.lit(0),
                                                  F.lit("Asia/Tokyo")).alias("ts"))
    assert bars.normalize(df).first().date == dt.date(2024, 1, 2)


def test_validation_counts_each_failure(spark, raw):
    wanted = spark.createDataFrame([("kept",), ("gaps",), ("free",), ("torn",), ("absent",), (None,)], "ticker string")
    v = {r.ticker: r for r in checks.validate_bars(raw, wanted).collect()}
    assert v["absent"].rows == 0 and v["absent"].failures == 1
    assert v["kept"].failures == 0 and v[None].rows == 1
    assert v["gaps"].missing_prices == 3 and v["free"].nonpositive_prices == 2 and v["torn"].unbracketed == 2
    undated = raw.where("ticker = 'kept'").withColumn("date", F.when(F.col("date") == day(1), F.col("date")))
    assert checks.validate_bars(undated, wanted.where("ticker = 'kept'")).first().duplicate_dates == 0


def test_validation_counts_rows_that_arrive_late(spark):
    order = [3, 1, 2, 2, 5, 4]
    rows = [("T", day(d), n, 5.0, 6.0, 4.0, 5.0, 1, 0.0, 0.0) for n, d in enumerate(order)]
    df, wanted = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame([("T",)], "ticker string")
    late = sum(b < a for a, b in zip(order, order[1:]))
    assert checks.validate_bars(df, wanted, arrival="seq").first().out_of_order == late == 2
    assert checks.out_of_order(df, "ticker", "date", "seq").first().late == 2


def test_fixture_rule_counts(spark):
    raw = fixtures.raw_bars(spark, SF01)
    assert raw.count() == 8828
    annotated = bars.annotate_repairs(bars.normalize(raw)).cache()
    report = {r.rule: r.dropped for r in bars.report_from(annotated).groupBy("rule").agg(
        F.sum("dropped").alias("dropped")).collect()}
    assert report == {"duplicate_date": 205, "incomplete": 162, "nonpositive": 156, "inconsistent": 135}
    assert bars.clean_from(annotated).count() == 8170
    annotated.unpersist()


def loop_metrics(closes):
    """The four metrics of one ticker's closes by plain loops."""
    out, moves = [], []
    for n, c in enumerate(closes):
        moves.append(None if n == 0 or closes[n - 1] == 0 else c / closes[n - 1] - 1)
        near = [m for m in moves[-30:] if m is not None]
        mean = sum(near) / len(near) if near else 0.0
        sd = math.sqrt(sum((m - mean) ** 2 for m in near) / (len(near) - 1)) if len(near) > 1 else None
        out.append((100 * c / closes[0], None if moves[-1] is None else 100 * moves[-1], 100 * (c / max(closes[: n + 1]) - 1),
                    None if sd is None else 100 * math.sqrt(252) * sd))
    return out


def test_metrics_equal_plain_loops(spark):
    ohlcv = fixtures.ohlcv(spark, SF01)
    series = {}
    for r in ohlcv.orderBy("date").collect():
        series.setdefault(r.ticker, []).append(r.close)
    got = {}
    for r in bars.bar_metrics(ohlcv).orderBy("date").collect():
        got.setdefault(r.ticker, []).append((r.indexed_close, r.daily_return_pct, r.drawdown_pct, r.volatility_30d_pct))
    assert got.keys() == series.keys()
    for ticker, closes in series.items():
        for mine, want in zip(got[ticker], loop_metrics(closes), strict=True):
            assert [m is None for m in mine] == [w is None for w in want]
            assert [m for m in mine if m is not None] == pytest.approx([w for w in want if w is not None], rel=1e-9, abs=1e-9)


def test_bars_without_a_ticker_have_metrics_and_a_distribution(spark):
    rows = [(None, day(n), n, c, c, c, c, 1, 0.0, 0.0) for n, c in enumerate((10.0, 11.0, 0.0, 9.9), 1)]
    m = bars.bar_metrics(spark.createDataFrame(rows, COLUMNS).drop("seq"))
    got = m.orderBy("date").collect()
    assert [r.daily_return_pct for r in got] == [None, pytest.approx(10.0), -100.0, None]
    for exact in (True, False):
        line = bars.return_distribution(m, exact=exact).collect()
        assert [(r.ticker, r.n, r["min"], r.outliers) for r in line] == [(None, 2, -100.0, 0)]


@pytest.mark.parametrize("session_zone", ["America/Los_Angeles", "Asia/Kolkata", "UTC"])
def test_local_dates_ignore_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        got = bars.normalize(fixtures.raw_bars(spark, SF01)).select("ticker", "date", "seq")
        want = fixtures.base_bars(spark, SF01).select("ticker", "date")
        assert got.select("ticker", "date").distinct().exceptAll(want).count() == 0
        assert got.count() == 8828
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_last_row_is_one_row_and_ties_are_told(spark):
    rows = [
        ("one", 1, 1.0, "a"), ("one", 2, 2.0, "b"),                      # the larger number
        ("tied", 5, 1.0, "a"), ("tied", 5, 2.0, "b"), ("tied", 4, 9.0, "z"),
        ("same", 7, 1.0, "a"), ("same", 7, 1.0, "a"),                    # equal rows are no tie
        ("late", None, 9.0, "z"), ("late", -(2**63), 1.0, "a"),          # no number is before any
        ("none", None, 1.0, "a"), ("none", None, 2.0, "b"), ("alone", None, 3.0, None),
        (None, 2**63 - 1, None, None), (None, 2**63 - 2, 1.0, "a"),
    ]
    df = spark.createDataFrame(rows, "k string, seq bigint, x double, y string")
    for parts in (1, 5):
        got = {r.k: (r.seq, r.x, r.y, r.n, r.tied) for r in bars.keep_last(df.repartition(parts), ["k"], "seq", "n", "tied").collect()}
        assert got["one"] == (2, 2.0, "b", 2, False) and got["same"] == (7, 1.0, "a", 2, False)
        assert got["late"] == (-(2**63), 1.0, "a", 2, False) and got["alone"] == (None, 3.0, None, 1, False)
        assert got[None] == (2**63 - 1, None, None, 2, False)
        assert got["tied"][:3] in {(5, 1.0, "a"), (5, 2.0, "b")} and got["tied"][3:] == (3, True)
        assert got["none"][:3] in {(None, 1.0, "a"), (None, 2.0, "b")} and got["none"][3:] == (2, True)
        assert parts == 1 or got == first
        first = got
    with pytest.raises(TypeError):
        bars.keep_last(df, ["k"], "x")


def test_a_run_with_several_last_bars_stops(spark, tmp_out):
    from tidemark.plans import bars_chain
    raw = fixtures.raw_bars(spark, SF01).drop("arrival")
    doubled = raw.unionByName(raw.where("ticker = '2-HIGH'").withColumn("Close", F.col("Close") + 0.25))
    with pytest.raises(bars_chain.ValidationFailed, match="several last bars: 2-HIGH"):
        bars_chain.bars_chain(spark, doubled, tmp_out)
    with pytest.raises(bars_chain.ValidationFailed, match="several last bars: 2-HIGH"):
        bars_chain.bars_rebuild(spark, doubled, tmp_out, "5y/1d")
