"""Every named query against its SQL in DuckDB, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from prospectra.plans import catalog, oracle, pages, queries, service, webs

from .conftest import SF

QUERIES, ORACLE_SQL = {**queries.QUERIES, **catalog.QUERIES, **webs.QUERIES, **pages.QUERIES, **service.QUERIES}, {**oracle.ORACLE_SQL, **catalog.ORACLE_SQL, **webs.ORACLE_SQL, **pages.ORACLE_SQL, **service.ORACLE_SQL}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        return repr(round(float(v), 6))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    got = sorted(tuple(map(plain, r)) for r in df.select(columns).collect())
    assert got == sorted(tuple(plain(r[k]) for k in order) for r in rel.fetchall())


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0


def test_filters_reach_the_scan(spark):
    plan = QUERIES["venue_detail"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "documents" not in plan and "PythonUDF" not in plan
