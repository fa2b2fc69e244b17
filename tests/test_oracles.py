"""Every registered query equals its DuckDB oracle (sf0.001 tables)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.compare_oracles import TABLES, rows_of
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()
# queries that SQL cannot express are tested against brute force instead
QUERIES = {name: q for name, q in entry.queries().items() if name in ORACLES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLES[name])
    want, want_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert got == want
