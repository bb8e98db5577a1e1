"""Every query of the catalog against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from skiagram.plans import catalog, kernel_queries  # noqa: F401  (its queries are in the catalog)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    ours = catalog.QUERIES[name](spark, SF)
    theirs = duck.sql(catalog.SQL[name])
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    a = sorted(str(tuple(r[c] for c in cols)) for r in ours.collect())
    b = sorted(str(tuple(r[theirs.columns.index(c)] for c in cols)) for r in theirs.fetchall())
    assert a == b
