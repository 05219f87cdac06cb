"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from monthwise.plans.catalog import registry
from monthwise.sources.tables import TABLES
from tests.conftest import SF_SMALL


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry()) <= set(E.queries()) and set(registry()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ord", "name", "html"]
    assert df.count() == 5
