"""Every query against its SQL, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from inkmill import queries
from inkmill import queries_files  # noqa: F401


def rows(frame):
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) and v == int(v) else v
    return sorted((tuple(clean(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = queries.QUERIES[name](spark, sf).toPandas(), duck.sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
