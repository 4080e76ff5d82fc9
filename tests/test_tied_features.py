"""Days whose largest z-scores are equal but for rounding: the top feature is the one that SQL names."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.columns import entropy
from pulsegrid.operators import baseline
from pulsegrid.plans import registry

#: Screens are the same every day, so UserAct and daily_event_cnt, and their z-scores, move together.
DAILY = [("view", 50, 10), ("purchase", 50, 10), ("error", 10, 2), ("error", 95, 2)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    draw, rows = random.Random(11), []
    for user in range(8):
        for day in range(30):
            kinds = [(t, k) for t, k, n in [*DAILY, ("click", 50, draw.randint(10, 90)), ("click", 5, draw.randint(1, 9))] for _ in range(n)]
            draw.shuffle(kinds)
            begin = datetime(2024, 1, 1) + timedelta(days=day, hours=-9)
            for i, (kind, k) in enumerate(kinds):
                ts = begin + timedelta(seconds=86400 * (i + 0.9 * draw.random()) / len(kinds))
                rows.append((len(rows), ts, user, kind, 1.0, f'{{"k": {k}}}'))
    made = tmp_path_factory.mktemp("tied")
    names = {"event_id": pa.int64(), "ts": pa.timestamp("us"), "user_id": pa.int64(), "event_type": pa.string(), "value": pa.float64(), "props": pa.string()}
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*rows), names.values())], names=list(names)), made / "events.parquet")
    return str(made)


def test_deviations_have_the_bits_of_sql(spark):
    """Means and deviations of whole numbers equal SQL's exactly, not only to some digits."""
    rng = np.random.default_rng(2)
    rows = [(u, i, [None if rng.random() < 0.3 else float(v) for v in rng.integers(0, 40, 2)]) for u in range(40) for i in range(30)]
    frames = ((14, 5), (7, 3))
    stats = baseline.running_stats(frames, (0.0, 0.0))
    table = spark.createDataFrame(rows, "u int, i long, x array<double>")
    got = table.repartition(2, "u").sortWithinPartitions("u", "i").select("u", "i", stats("i", "x").alias("s")).collect()
    con = duckdb.connect()
    con.register("t", pa.table({"u": [r[0] for r in rows], "i": [r[1] for r in rows], **{c: pa.array([r[2][j] for r in rows], pa.float64()) for j, c in enumerate("ab")}}))
    over = {n: f"OVER (PARTITION BY u ORDER BY i ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n, _ in frames}
    columns = [f"CASE WHEN count({c}) {over[n]} >= {least} THEN {f}({c}) {over[n]} {other} END" for n, least in frames for f, other in (("avg", ""), ("stddev_pop", "ELSE 0.0")) for c in "ab"]
    want = {(u, i): s for u, i, *s in con.execute(f"SELECT u, i, {', '.join(columns)} FROM t").fetchall()}
    assert len(got) == len(want) == 1200
    assert [(r["u"], r["i"]) for r in got if r["s"] != want[r["u"], r["i"]]] == []


def test_entropy_of_equal_counts_has_the_bits_of_sql(spark):
    """Days of few hours with as many events each, whose z-scores tie with those of counts."""
    days = [[c] * hours + [0] * (24 - hours) for c in (10, 20, 21, 30) for hours in (1, 2, 3, 4)]
    table = spark.createDataFrame([(d, sum(d)) for d in days], "counts array<long>, total long")
    got = [r[0] for r in table.select(entropy(F.col("counts"), F.col("total"))).collect()]
    hist = "(SELECT unnest(?::BIGINT[]) AS c)"  # as in the chain's rhythm0
    want = [duckdb.execute(f"SELECT ln(sum(c)) - sum(c * ln(c)) / sum(c) FROM {hist} WHERE c > 0", [d]).fetchone()[0] for d in days]
    assert got == want and np.allclose(want, [np.log(h) for _ in range(4) for h in (1, 2, 3, 4)])


@pytest.mark.parametrize("name", ["state_out", "state_out_surrogate", "top_z_by_state"])
def test_top_feature_of_tied_days_is_that_of_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    df = registry.QUERIES[name](spark, folder)
    keys = [c for c in ("uuid", "date", "cat_state", "top_z_feature", "n") if c in df.columns]
    want = con.execute(f"SELECT {', '.join(keys)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert {"daily_event_cnt_z", "UserAct_z"} <= {r[keys.index("top_z_feature")] for r in want}
    assert Counter(map(tuple, df.select(*keys).collect())) == Counter(want)
