"""Every registered query against its SQL, on the smallest tables."""

import os
from pathlib import Path

import pytest

from terrazzo.plans import catalog, strips  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA / f}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v != v else round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "__int__") and not isinstance(v, str) else str(v)
    return list(frame.columns), sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert rows(catalog.QUERIES[name](spark, str(DATA)).toPandas()) == rows(duck.execute(catalog.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, str(DATA)).columns
