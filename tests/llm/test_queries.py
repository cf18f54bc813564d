"""Every query with SQL against DuckDB, and the others for rows, on the smallest tables."""

import os

import pytest

from tests.test_queries import FOLDER, plain, tables  # noqa: F401
from trajlake.llm import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
EMPTY = {"p5_violated", "p7_found", "p7_violated", "p8_violated"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, tables, name):  # noqa: F811
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    if name not in registry.ORACLES:
        assert got or name in EMPTY
        return
    sql = tables.sql(registry.ORACLES[name])
    assert sorted(sql.columns) == columns
    at = [sql.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in sql.fetchall())
