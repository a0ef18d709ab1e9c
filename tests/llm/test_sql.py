"""Queries that SQL can express equal their SQL."""

from __future__ import annotations

import duckdb
import pytest

from echolattice.llm.queries import QUERIES, TWINS


@pytest.fixture(scope="module")
def con(sf):
    out = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        out.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return out


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_sql(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    names = sorted(df.columns)
    cursor = con.execute(TWINS[name])
    assert sorted(d[0] for d in cursor.description) == names
    place = [[d[0] for d in cursor.description].index(n) for n in names]
    key = lambda r: tuple((x is not None, x) for x in r)
    theirs = sorted((tuple(r[i] for i in place) for r in cursor.fetchall()), key=key)
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=key) == theirs and theirs
