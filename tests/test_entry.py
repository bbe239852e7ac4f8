"""The driver contract: entry, queries, oracle_sql."""

import __spark_entry__ as entry
from tidemark.plans import catalog


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["location", "parameter"]


CORE = {
    "location_profile", "series_features", "pivot_mean", "unpivot_values", "date_parts",
    "bars_clean", "bars_repair_report", "ticker_metrics", "return_distribution", "scoreboard",
    "upsert_report", "fingerprint", "stale_inputs", "sensor_checks", "check_bars",
    "readings_page", "search_ids", "sensor_summary", "table_health", "synthetic_readings",
}


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert CORE <= set(q)
    assert CORE - {"synthetic_readings"} <= set(o)


def test_query_names_are_identifiers():
    for name in entry.queries():
        assert name.isidentifier() and name == name.lower()


def test_rows_only_queries_run(spark):
    from sf_tables import SF001
    q, o = catalog.load_all()
    for name in sorted(set(q) - set(o)):
        assert q[name](spark, SF001).count() > 0, name
