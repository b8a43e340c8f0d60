"""Every corpus query that SQL can state against its SQL, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from inkmill.llm import registry


def rows(frame):
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, float) else v
    return sorted((tuple(clean(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    got, want = registry.QUERIES[name](spark, sf).toPandas(), con.sql(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    assert rows(got) == rows(want)
