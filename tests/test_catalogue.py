"""Every registered query of the engine's own operators against its SQL."""

import os

import duckdb
import pandas as pd
import pytest

from folioflow import catalogue, catalogue_articles, catalogue_flows, catalogue_plans, catalogue_search, catalogue_stores  # noqa: F401

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    cell = lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else round(float(v), 6) if isinstance(v, int | float) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)
    df = df[sorted(df.columns)]
    return sorted((tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    if name in catalogue.ORACLE_SQL:
        want = duck.execute(catalogue.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert len(got)
