"""Queries with a SQL twin, on the smallest tables."""

import duckdb
import pytest

from tidewell.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[c] for c in names)) for r in df.collect())


def test_all_are_registered():
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]
