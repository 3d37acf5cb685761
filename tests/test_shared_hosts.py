"""Named queries over venues that share hosts, which the smallest tables have none of (names and hosts repeat every 2,040 customers)."""

import duckdb
import pytest

from prospectra.plans import catalog

from .test_queries import plain


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("shared_hosts"))
    keys = [k + 2040 * j for k in range(12) for j in range(4)]
    spark.createDataFrame([(k, k % 25) for k in keys], "c_custkey long, c_nationkey long").coalesce(1).write.parquet(f"{at}/customer.parquet")
    return at


def against_sql(spark, at, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{at}/customer.parquet/*.parquet'")
    rel, df = con.sql(catalog.ORACLE_SQL[name]), catalog.QUERIES[name](spark, at)
    want = sorted(tuple(map(plain, r)) for r in rel.fetchall())
    assert want and sorted(tuple(map(plain, r)) for r in df.select(*rel.columns).collect()) == want


def test_city_pages(spark, shared):
    """a page of one venue is not that of the others on its host."""
    against_sql(spark, shared, "city_pages")


def test_swept(spark, shared):
    """a mailbox's first page is the venue's own, not the first of its host."""
    against_sql(spark, shared, "swept")
