"""Every event query against its SQL in DuckDB on the small tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import pytest

from pulsegrid.plans import registry

DATA = os.environ.get("PULSEGRID_TEST_DATA", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 5) if isinstance(v, float) else v


def same(x, y) -> bool:
    if isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
        return math.isclose(x, y, abs_tol=2e-5)
    return str(x) == str(y)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    cursor = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    theirs = [tuple(plain(dict(zip(names, r))[c]) for c in cols) for r in cursor.fetchall()]
    ours = [tuple(plain(r[c]) for c in cols) for r in df.collect()]

    def order(row):
        return tuple(str(v) for c, v in zip(cols, row) if c in ("uuid", "date", "seq", "run", "prev", "cur", "rule", "feature", "cat_state")) + tuple(map(str, row))

    assert len(ours) == len(theirs)
    for a, b in zip(sorted(ours, key=order), sorted(theirs, key=order)):
        assert all(same(x, y) for x, y in zip(a, b)), (cols, a, b)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0
