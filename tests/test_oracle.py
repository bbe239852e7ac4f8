"""Every registered query with an oracle equals DuckDB, value for value, at sf0.001."""

import collections

import duckdb
import pytest

from tidemark.plans import catalog
from tidemark.sources.tables import TABLE_NAMES
from tools.oracle_check import norm, spark_type_name

from sf_tables import SF001

QUERIES, ORACLES = catalog.load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = df.collect()
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        assert spark_type_name(f.dataType) == types[f.name], f.name
    order = sorted(df.columns)
    si = [df.columns.index(c) for c in order]
    oi = [rel.columns.index(c) for c in order]
    a = collections.Counter(tuple(norm(r[i]) for i in si) for r in rows)
    b = collections.Counter(tuple(norm(r[i]) for i in oi) for r in rel.fetchall())
    assert a == b
