"""Windows, running maps, states and quantiles in segments against whole users and plain loops."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.config import PipelineConfig
from pulsegrid.functions.quantiles import grouped_quantiles
from pulsegrid.operators import features, segments
from pulsegrid.sources.events import standard_events


def series(n: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = [("long", i, rng.random() if rng.random() < 0.8 and i > 3 else None) for i in range(n)]
    return rows + [("short", i, float(i)) for i in range(3)] + [("empty", i, None) for i in range(4)] + [(None, i, 1.0 + i) for i in range(9)]


@pytest.mark.parametrize("alpha", [0.25, 0.001, 0.9, 1.0])
@pytest.mark.parametrize("size", [None, 3, 7])
def test_smoothing_is_the_exact_recurrence(spark, alpha, size):
    rows = series(500)
    table = spark.createDataFrame(rows, "uuid string, day int, x double").repartition(5)
    got = {(r["uuid"], r["day"]): r["mean"] for r in segments.smoothed(table, ["uuid"], "day", "x", alpha, "mean", size, fold=11).collect()}
    assert len(got) == len(rows)
    last: dict = {}
    for user, day, x in rows:
        if x is not None:
            last[user] = x if last.get(user) is None else (1 - alpha) * last[user] + alpha * x
        want = last.get(user)
        assert (got[(user, day)] is None) == (want is None) and (want is None or abs(got[(user, day)] - want) <= 1e-12 * max(1, abs(want)))


def test_early_values_are_not_cut_off(spark):
    """A value whose weight is below 2^-60 still shows where all later ones are zero."""
    table = spark.createDataFrame([("u", i, 1.0 if i == 0 else 0.0) for i in range(400)], "uuid string, day int, x double")
    got = [r["m"] for r in segments.smoothed(table, ["uuid"], "day", "x", 0.25, "m", None, fold=50).orderBy("day").collect()]
    assert got[399] > 0 and all(abs(m / 0.75**i - 1) < 1e-12 for i, m in enumerate(got))


@pytest.mark.parametrize("size", [1, 7, 40])
def test_windows_over_segments_equal_those_over_users(spark, size):
    table = spark.createDataFrame(series(300), "uuid string, day int, x double").repartition(6)
    held: list[int] = []

    def compute(rows, part):
        if len(part) > 1:
            held.append(rows.groupBy(*part).count().agg(F.max("count")).first()[0])
        w = Window.partitionBy(*part).orderBy("day")
        return rows.select("*", F.avg("x").over(w.rowsBetween(-30, -1)).alias("mean"), F.lag("day").over(w).alias("before"), F.count("x").over(w.rowsBetween(-9, 0)).alias("n"))

    key = lambda r: (r["uuid"] or "", r["day"])
    whole = sorted(segments.windowed(table, ["uuid"], "day", 30, compute, None).collect(), key=key)
    cut = sorted(segments.windowed(table, ["uuid"], "day", 30, compute, size).collect(), key=key)
    assert len(cut) == len(whole) and max(held) <= size + 30
    for a, b in zip(whole, cut):
        assert tuple(a)[:3] == tuple(b)[:3] and (a["before"], a["n"]) == (b["before"], b["n"])
        assert a["mean"] == b["mean"] or abs(a["mean"] - b["mean"]) < 1e-12


def test_quantiles_of_groups(spark):
    rng = random.Random(2)
    rows = [(f"g{g}", rng.choice([None, 1.0, 2.5, rng.gauss(0, 1)])) for g in range(5) for _ in range(1 + 200 * (g == 0) + g)] + [("none", None), (None, 3.0)]
    got = {r["g"]: r for r in grouped_quantiles(spark.createDataFrame(rows, "g string, x double").repartition(7), ["g"], F.col("x"), [0.0, 0.8, 0.99]).collect()}
    want = defaultdict(list)
    for g, x in rows:
        if x is not None and g is not None:
            want[g].append(x)
    assert set(got) == set(want)
    for g, xs in want.items():
        assert got[g]["n"] == len(xs) and np.allclose(got[g]["q"], np.quantile(xs, [0.0, 0.8, 0.99]), atol=1e-12)


NAMES = ("SCREEN_INTERACTIVE", "SCREEN_NON_INTERACTIVE", "USER_INTERACTION", "KEYGUARD_HIDDEN", "WIFI_SSID", "CELL_CHANGE", "STEP_COUNT", "HEARTBEAT")


def day_of_events(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        name = rng.choice(NAMES)
        ms = 1_704_067_200_000 + rng.randrange(0, 30 * 3_600_000, 60_000)  # ties in time, two days
        out.append((rng.choice("ab"), i, name, ms, rng.choice(["x", "y", None]), float(rng.randint(0, 3)), rng.choice([1, 5, None])))
    return out


def sessions(rows: list[tuple]) -> dict[tuple, list[float]]:
    """The state machine on each user's day."""
    out: dict[tuple, list[float]] = defaultdict(list)
    for user in "ab":
        opened: dict = {}
        for _, _, name, ms, *_ in sorted((r for r in rows if r[0] == user), key=lambda r: (r[3], r[1])):
            day = dt.date(1970, 1, 1) + dt.timedelta(days=ms // 86_400_000)
            if name == "SCREEN_INTERACTIVE":
                opened.setdefault(day, ms)
            elif name == "SCREEN_NON_INTERACTIVE" and day in opened:
                sec = (ms - opened.pop(day)) / 1000
                if 0 < sec < 21600:
                    out[(user, day)].append(sec)
    return out


@pytest.mark.parametrize("limit", [3, 7, 50])
def test_days_in_segments_equal_whole_days(spark, limit):
    rows = day_of_events(600, limit)
    raw = spark.createDataFrame(rows, "uuid string, seq long, event_name string, timestamp long, wifi_ssid string, cell_lac double, step_count int").repartition(5)
    cfg = PipelineConfig(epoch_unit="ms", min_rhythm_events=10, min_gap_events=10)
    events = standard_events(raw, cfg)
    states, cut = features.day_states(events, replace(cfg, segment_events=limit, segment_slot_ms=1))
    assert cut and states.agg(F.max(F.size("gaps")), F.max(F.size("ssids"))).first()[0] <= limit + 5
    whole = {(r["uuid"], r["date"]): r for r in features.daily_blocks(events, cfg).collect()}
    parts = {(r["uuid"], r["date"]): r for r in features.daily_blocks(events, replace(cfg, segment_events=limit, segment_slot_ms=1, segment_rows=1)).collect()}
    assert whole.keys() == parts.keys() and len(whole) == 4
    for k, a in whole.items():
        for c, x in a.asDict().items():
            y = parts[k][c]
            assert x == y or abs(x - y) < 1e-9, (k, c, x, y)
    for k, secs in sessions(rows).items():
        assert parts[k]["session_cnt"] == len(secs) and abs(parts[k]["session_total_sec"] - sum(secs)) < 1e-6
