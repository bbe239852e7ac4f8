"""Clustered, ranked and gram layouts, and what they read by the event log."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layouts, serve

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROWS = [("0000001", None, 1), ("0000001", 5.0, 2), ("0000002", 5.0, 3), ("0000003", 5.0, 4), ("0000002", 1.0, 5), ("0000002", None, 6), ("abc0012", 7.0, 7)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS * 1, "sensor_id string, value double, seq bigint").repartition(3)


def test_requests_read_and_write_a_small_part():
    """Loads write what they touch; lookups, deep pages and searches read a small share of the rows."""
    out = subprocess.run([sys.executable, os.path.join(REPO, "tools", "io_report.py")], capture_output=True, text=True, timeout=900, cwd=REPO).stdout
    told = json.loads(out.strip().splitlines()[-1])
    n = told["rows"]
    assert told["load_all"]["written"] > n and told["load_nothing_new"]["bytes_written"] == 0
    assert told["load_one_ticker"]["written"] < n / 40 and told["load_one_ticker"]["bytes_written"] < told["load_all"]["bytes_written"] / 20
    assert 0 < told["found"] <= told["lookup"]["read"] < n / 20
    assert told["page"] == 50 and told["deep_page"]["read"] < n / 10
    assert told["hits"] and told["search"]["read"] < told["gram_rows"]


def test_clustered_lookup(spark, rows, tmp_out):
    layouts.write_clustered(rows, f"{tmp_out}/t", ["sensor_id", "seq"])
    assert sorted(r.seq for r in layouts.lookup(spark, f"{tmp_out}/t", "0000002").collect()) == [3, 5, 6]
    assert layouts.lookup(spark, f"{tmp_out}/t", "0000009").count() == 0
    with pytest.raises(ValueError):
        layouts.lookup(spark, f"{tmp_out}/t", "not an id")


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_ranks_are_the_places_in_the_order(spark, rows, tmp_out, ranges):
    table = layouts.RankedTable(spark, f"{tmp_out}/t")
    table.write(rows, [serve.sort_key("value", "desc"), F.col("seq").asc()], ranges)
    want = [r[2] for r in sorted(ROWS, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2]))]
    assert [r.seq for r in table.page(0, 100).collect()] == want and table.total() == len(ROWS)
    for offset in range(len(ROWS) + 2):
        page = table.page(offset, 2).collect()
        assert [r.seq for r in page] == want[offset : offset + 2]
        assert [r.rank for r in page] == list(range(offset, min(offset + 2, len(ROWS))))
    with pytest.raises(ValueError):
        table.page(-1, 2)


@pytest.mark.parametrize("ranges", [1, 4])
def test_pages_of_one_entity(spark, rows, tmp_out, ranges):
    table = layouts.RankedTable(spark, f"{tmp_out}/t")
    table.write(rows, [F.col("sensor_id").asc(), serve.sort_key("value", "asc"), F.col("seq").asc()], ranges)
    assert [r.seq for r in table.page(0, 10, "0000002").collect()] == [5, 3, 6]
    assert [r.seq for r in table.page(2, 10, "0000002").collect()] == [6]
    assert table.page(3, 10, "0000002").count() == 0 and table.page(0, 10, "0000009").count() == 0


def test_empty_ranked_table(spark, rows, tmp_out):
    table = layouts.RankedTable(spark, f"{tmp_out}/t")
    table.write(rows.where("false"), [F.col("seq").asc()], 4)
    assert table.total() == 0


@pytest.mark.parametrize("fragment", ["000", "0000002", "bc00", "c0012", "12", "a", "", None, "999", "zzzz"])
def test_indexed_search_equals_the_scan(spark, rows, tmp_out, fragment):
    more = rows.unionByName(spark.createDataFrame([(None, 1.0, 8), ("ab", 1.0, 9), ("", 1.0, 10), ("aaaaaaa", 1.0, 11)], rows.schema))
    index = layouts.GramIndex(spark, f"{tmp_out}/g")
    index.write(more)
    want = [(r.sensor_id, r.total) for r in serve.search_ids(more, fragment, 3).collect()]
    assert sorted((r.sensor_id, r.total) for r in index.search(fragment, 3).collect()) == sorted(want)
