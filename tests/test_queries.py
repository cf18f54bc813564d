"""Every core query with SQL, against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from trajlake.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else round(v, 9)
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="session")
def tables():
    c = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, tables, name):
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    if name not in registry.ORACLES:
        assert got
        return
    sql = tables.sql(registry.ORACLES[name])
    assert sorted(sql.columns) == columns
    at = [sql.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in sql.fetchall())
