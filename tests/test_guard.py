"""Guarded writes and stored sketches."""

import datetime as dt

import pytest

from tidemark.operators import guard, profile
from tidemark.sources.schemas import Field, TableType

TABLE = TableType(
    "sizes",
    (Field("id", "bigint"), Field("kind", "string", values=("a", "b")), Field("low", "int", least=0, most="high"), Field("high", "int", nullable=True),
     Field("x", "double", nullable=True), Field("y", "double", nullable=True)),
    key=("id",), paired=(("x", "y"),),
)
GOOD = [(1, "a", 0, 1, None, None), (2, "b", 3, None, 1.0, 2.0)]
BAD = [(None, "a", 0, 1, None, None), (4, "c", -1, 1, None, None), (5, "a", 2, 1, None, None), (6, "a", 0, 1, 1.0, None)]


def rows(spark, data):
    return spark.createDataFrame([(*r, "extra") for r in data], f"{TABLE.ddl}, other string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_sound_rows_are_published(spark, tmp_out):
    w = guard.guarded_write(rows(spark, GOOD), tmp_out, TABLE)
    assert (w.version, w.rows, w.kept, w.quarantined, w.repeated, w.published) == (0, 2, 2, 0, 0, True)
    assert set(w.violations.values()) == {0}
    published = guard.read_published(spark, tmp_out, TABLE)
    assert ids(published) == [1, 2] and published.columns == [f.name for f in TABLE.fields]
    assert guard.read_quarantine(spark, tmp_out, TABLE, 0).count() == 0


def test_broken_rows_stop_the_version(spark, tmp_out):
    assert guard.read_published(spark, tmp_out, TABLE).count() == 0
    guard.guarded_write(rows(spark, GOOD), tmp_out, TABLE)
    w = guard.guarded_write(rows(spark, GOOD[:1] + BAD), tmp_out, TABLE)
    assert (w.version, w.rows, w.kept, w.quarantined, w.published) == (1, 5, 1, 4, False)
    assert {k: n for k, n in w.violations.items() if n} == {
        "id is set": 1, "kind is one of a, b": 1, "low is at least 0": 1, "low is at most high": 1, "x and y are set together": 1}
    assert ids(guard.read_published(spark, tmp_out, TABLE)) == [1, 2]  # readers see the version before
    held = {r.id: sorted(r._broken) for r in guard.read_quarantine(spark, tmp_out, TABLE, 1).collect()}
    assert held == {None: ["id is set"], 4: ["kind is one of a, b", "low is at least 0"], 5: ["low is at most high"], 6: ["x and y are set together"]}


def test_leave_to_quarantine_some(spark, tmp_out):
    w = guard.guarded_write(rows(spark, GOOD * 1 + BAD[:2]), tmp_out, TABLE, max_bad_share=0.5)
    assert w.published and ids(guard.read_published(spark, tmp_out, TABLE)) == [1, 2]
    assert not guard.guarded_write(rows(spark, GOOD + BAD[:3]), tmp_out, TABLE, max_bad_share=0.5).published


def test_repeated_keys_and_nothing_at_all_are_stopped(spark, tmp_out):
    w = guard.guarded_write(rows(spark, GOOD + GOOD[:1]), tmp_out, TABLE, max_bad_share=1.0)
    assert (w.repeated, w.quarantined, w.published) == (1, 0, False)
    assert not guard.guarded_write(rows(spark, []), tmp_out, TABLE).published
    assert guard.guarded_write(rows(spark, []), tmp_out, TABLE, allow_empty=True).published
    assert guard.read_published(spark, tmp_out, TABLE).count() == 0
    with pytest.raises(ValueError, match="missing columns: low"):
        guard.guarded_write(rows(spark, GOOD).drop("low"), tmp_out, TABLE)


def test_stored_sketches_answer_any_range(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    data = [(f"s{(n * 7 + k) % 40}", "x" if k % 3 else None, day(n)) for n in range(20) for k in range(9)] + [(None, "x", day(3))]
    df = spark.createDataFrame(data, "sensor_id string, location string, reading_date date")
    sketches = profile.daily_sketches(df, ["location"])
    assert sketches.count() == 40
    spans = {"all": (0, 19), "one": (4, 4), "some": (3, 11), "none": (50, 60)}
    ranges = spark.createDataFrame([(k, day(a), day(b)) for k, (a, b) in spans.items()], "name string, first_day date, last_day date")
    got = {(r.range, r.location): r.approx_distinct for r in profile.distinct_between(sketches, ["location"], ranges).collect()}
    want = {}
    for s, place, d in data:
        for k, (a, b) in spans.items():
            if s is not None and day(a) <= d <= day(b):
                want.setdefault((k, place), set()).add(s)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - len(v)) <= max(1, 0.02 * len(v)) for k, v in want.items())
