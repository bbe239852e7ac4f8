"""Serving queries: paging is disjoint and complete, nulls placed per the API."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import serve
from tidemark.operators.series import series_features
from tidemark.sources import fixtures

from sf_tables import SF001


@pytest.fixture(scope="module")
def feats(spark):
    f = series_features(fixtures.readings(spark, SF001)).cache()
    yield f
    f.unpersist()


def sensor(feats):
    return feats.agg(F.min("sensor_id")).first()[0]


@pytest.mark.parametrize("sort,order", [("z_score", "desc"), ("delta", "asc"), ("reading_date", "asc")])
def test_pages_are_disjoint_and_complete(feats, sort, order):
    s = sensor(feats)
    total = serve.page_envelope(feats, s, sort=sort, order=order, limit=7).first().total
    seen = []
    for offset in range(0, total, 7):
        seen += [(r.parameter, r.reading_no) for r in serve.page(feats, s, sort=sort, order=order, limit=7, offset=offset).collect()]
    assert len(seen) == total == len(set(seen))


def test_nulls_first_descending_last_ascending(feats):
    s = sensor(feats)
    desc = serve.page(feats, s, sort="z_score", order="desc", limit=500).collect()
    asc = serve.page(feats, s, sort="delta", order="asc", limit=500).collect()
    nz = [r.z_score is None for r in desc]
    nd = [r.delta is None for r in asc]
    assert nz == sorted(nz, reverse=True) and nd == sorted(nd)
    assert any(nd)


def test_bad_arguments_raise(feats):
    with pytest.raises(ValueError):
        serve.page(feats, "0000001", sort="location")
    with pytest.raises(ValueError):
        serve.page(feats, "0000001", limit=501)
    with pytest.raises(ValueError):
        serve.page(feats, "BAD!")
    with pytest.raises(ValueError):
        serve.search_ids(feats, "a%", 10)


def test_search_envelope_truncates(feats):
    env = serve.search_envelope(feats, "0", 3).first()
    assert len(env["items"]) == 3 and env.total > 3 and env.truncated
    assert list(env["items"]) == sorted(env["items"])


def test_unknown_entity_and_filtered_out(feats):
    probe = serve.existence_probe(feats, "zzzzzzz", F.lit(True)).first()
    assert probe.exists_rows == 0
    s = sensor(feats)
    probe = serve.existence_probe(feats, s, F.col("parameter") == "nope").first()
    assert probe.exists_rows > 0 and probe.matching_rows == 0
    summary = serve.entity_summary(feats, "zzzzzzz").collect()
    assert len(summary) == 1 and summary[0].readings == 0 and summary[0].bad_pct is None


def test_documents_nest_sorted_parameters(feats):
    doc = serve.entity_documents(feats).where(F.col("sensor_id") == sensor(feats)).first()
    params = [p.parameter for p in doc.parameters]
    assert params == sorted(params) and sum(p.readings for p in doc.parameters) == doc.readings


def test_health_empty(spark, feats):
    empty = feats.limit(0)
    assert serve.table_health(empty, empty).first().status == "empty"
    assert serve.table_health(feats, feats).first().status == "ok"


def test_validate_rows_counts_each_rule(spark):
    import datetime as dt
    rows = [("abc1234", dt.date(2024, 1, 1), "X", "click", 1.0, "Good"),
            ("ABC1234", dt.date(2024, 1, 1), "X", "click", 1.0, "Good"),      # upper case id
            ("abc123", dt.date(2024, 1, 1), "X", "click", 1.0, "Good"),       # six characters
            ("abc1234", dt.date(2024, 1, 1), "X", "Pressure", 1.0, "Good"),   # unknown parameter
            ("abc1234", dt.date(2024, 1, 1), "X", "click", 1.0, "Meh"),       # unknown status
            (None, dt.date(2024, 1, 1), "X", "click", 1.0, None)]             # NULLs are invalid
    df = spark.createDataFrame(rows, "sensor_id string, reading_date date, location string, parameter string, "
                                     "value double, status string")
    v = serve.validate_rows(df, ["click", "view"]).first()
    assert (v.rows, v.bad_id, v.bad_parameter, v.bad_status) == (6, 3, 1, 2)
