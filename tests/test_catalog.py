"""Every registered query of the reference's operators against its SQL in DuckDB."""

import os

import duckdb
import pytest

from millrace.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, duck, name):
    got = catalog.queries()[name](spark, DATA)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(map(repr, want.fetchall()))
    assert rows == sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
