"""Every geospatial query against its SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

from tileframe.fixtures import TABLES
from tileframe.plans import queries

DATA = os.environ.get("TILEFRAME_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    key = lambda v: str(float(v)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)
    return sorted(tuple(key(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    if name in queries.SQL:
        expected = duck.sql(queries.SQL[name]).df()
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows(got) == rows(expected)
    else:
        assert len(got)
