"""Every core query that has an SQL twin gives the twin's rows on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

from sonarium.plans import registry

SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in SF.glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(rows, order):
    return sorted(tuple(repr(float(v)) if isinstance(v, float) else repr(v) for v in (r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    got = registry.queries()[name](spark, str(SF))
    twin = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in twin.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    assert plain(got.collect(), [got.columns.index(c) for c in order]) == plain(twin.fetchall(), [names.index(c) for c in order])
