"""Forest scores and the states made of them, against SQL that walks the saved table of nodes."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import numpy as np
import pytest

from pulsegrid.operators import anomaly
from pulsegrid.plans import oracles, registry

DATA = os.environ.get("PULSEGRID_TEST_DATA", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")

WALK = """
WITH RECURSIVE x AS (SELECT uuid, date, [{values}] AS v FROM scored WHERE scored),
names AS (SELECT tree, any_value(rows) FILTER (node = 1) AS n FROM nodes GROUP BY tree),
walk AS (
  SELECT uuid, date, v, tree, 1 AS node FROM x CROSS JOIN (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT uuid, date, v, w.tree, CASE WHEN floor(v[f.feature + 1] * 1e9 + 0.5) <= floor(f.threshold * 1e9 + 0.5) THEN f."left" ELSE f."right" END
  FROM walk w JOIN nodes f ON f.tree = w.tree AND f.node = w.node WHERE f.feature >= 0),
ends AS (SELECT uuid, date, avg(f.depth + CASE WHEN f.rows > 2 THEN 2 * (ln(f.rows - 1) + {gamma}) - 2 * (f.rows - 1) / f.rows WHEN f.rows = 2 THEN 1 ELSE 0 END) AS depth
  FROM walk w JOIN nodes f ON f.tree = w.tree AND f.node = w.node WHERE f.feature < 0 GROUP BY uuid, date),
norm AS (SELECT 2 * (ln(max(n) - 1) + {gamma}) - 2 * (max(n) - 1) / max(n) AS c FROM names)
SELECT uuid, date, pow(2, -depth / c) AS raw FROM ends CROSS JOIN norm"""


@pytest.fixture(scope="module")
def duck(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    scored = registry._scored(spark, DATA)
    nodes = anomaly.train_forest(scored, registry.CFG).toPandas()
    features = list(nodes["features"].iloc[0])
    con.register("nodes_", nodes.drop(columns="features"))
    con.execute("CREATE TABLE nodes AS SELECT * FROM nodes_")
    con.register("scored_", scored.select("uuid", "date", "scored", *features).toPandas())
    con.execute("CREATE TABLE scored AS SELECT * REPLACE (CAST(date AS DATE) AS date) FROM scored_")
    values = ", ".join(f"CASE WHEN isnan({c}) THEN 0 ELSE coalesce({c}, 0) END" for c in features)
    con.execute("CREATE TABLE forest_raw AS " + WALK.format(values=values, gamma=np.euler_gamma))
    return con


def compared(ours, cursor, rel: float) -> int:
    names = [d[0] for d in cursor.description]
    theirs = {(r[names.index("uuid")], str(r[names.index("date")])): dict(zip(names, r)) for r in cursor.fetchall()}
    assert len(ours) == len(theirs)
    for r in ours:
        other = theirs[(r["uuid"], str(r["date"]))]
        for c, x in r.asDict().items():
            y = other[c]
            assert str(x) == str(y) or isinstance(x, (int, float)) and math.isclose(x, y, rel_tol=rel, abs_tol=rel), (c, x, y)
    return len(ours)


def test_scores_equal_a_walk_in_sql(spark, duck):
    scored = registry._scored(spark, DATA)
    ours = anomaly.forest_scores(scored, anomaly.train_forest(scored, registry.CFG), registry.CFG)
    ours = ours.where("scored").selectExpr("uuid", "date", "anomaly_score_raw as raw").collect()
    assert compared(ours, duck.execute("SELECT * FROM forest_raw"), 1e-12) > 50


def test_states_equal_the_chain_over_these_scores(spark, duck):
    raw = "SELECT z.*, raw AS anomaly_score_raw FROM z LEFT JOIN forest_raw USING (uuid, date)"
    chain = [(name, raw if name == "anom0" else sql) for name, sql in oracles.CTES]
    assert compared(registry.QUERIES["state_out"](spark, DATA).collect(), duck.execute(oracles.upto("state", "SELECT * FROM state", chain)), 2e-6) > 200
    columns = "uuid, date, anomaly_score_raw, anomaly_score, anomaly_flag"
    ours = registry.QUERIES["isolation_forest_scores"](spark, DATA).collect()
    assert compared(ours, duck.execute(oracles.upto("anom", f"SELECT {columns} FROM anom", chain)), 2e-6) > 200
