"""Every registered query against its DuckDB oracle at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as se
from twinlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    a = sorted(tuple(_norm(v) for v in r) for r in df.collect())
    b = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert a == b


def test_entry_flagship(spark):
    rows = se.entry(spark).collect()
    assert {r.mode for r in rows} == {"multimodal", "text_only", "image_only"}
    assert all(r.total == rows[0].total for r in rows)


def test_rows_only_queries_run(spark):
    for name in set(se.queries()) - set(se.oracle_sql()):
        assert se.queries()[name](spark, SF).count() >= 1
