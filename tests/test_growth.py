"""What the event queries compute a row once for, and how wide the rows are that they write again."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.config import BASE_COLUMNS, DELTA_COLUMNS, PipelineConfig
from pulsegrid.operators import baseline, features, risk, segments


def test_frames_of_one_gathered_window(spark):
    """Means and deviations of each frame against plain numpy: nulls, a NaN, an infinity, no rows before and an empty batch."""
    rng = np.random.default_rng(3)
    rows = [[[None if rng.random() < 0.3 else float(v) for v in rng.normal(1e6, 1, 2)] for _ in range(n)] for n in (0, 1, 2, 5, 9, 9)]
    rows += [[[float("nan"), 1.0]] * 3 + [[2.0, float("inf")]] * 4]
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, before array<array<double>>").repartition(9)
    frames, floors = ((9, 2), (3, 1)), (0.25, 0.75)
    got = {r["i"]: r["s"] for r in table.select("i", baseline.frame_stats(frames, floors)("before").alias("s")).collect()}
    for i, before in enumerate(rows):
        want = []
        for n, least in frames:
            values = [[r[c] for r in before[-n:] if r[c] is not None] for c in (0, 1)]
            with np.errstate(all="ignore"):
                want += [np.mean(v) if len(v) >= least else None for v in values]
                want += [np.maximum(np.std(v), f) if len(v) >= least else f for v, f in zip(values, floors)]
        assert len(got[i]) == len(want)
        for a, b in zip(got[i], want):
            assert a is None and b is None or np.isclose(a, b, rtol=1e-12, equal_nan=True)


def test_risks_are_computed_on_the_columns_they_use(spark):
    """The intermediate baselines, five kinds of each base column, aren't carried through the tables of the risk steps."""
    kinds = [f"{c}_{x}_{k}" for c in BASE_COLUMNS for x in ("mean", "std") for k in ("lt_g", "st_g", "early_g", "st_own", "early_own", "st_s", "early_s", "final")]
    rows = spark.range(1).select(F.lit("u").alias("uuid"), F.lit(1.0).alias("Screen_z"), F.lit(1.0).alias("own"), *[F.lit(1.0).alias(c) for c in (*BASE_COLUMNS, *kinds)])
    used = risk.risk_inputs(rows, PipelineConfig()).columns
    assert {"uuid", "Screen_z", *BASE_COLUMNS, "Screen_mean_early_s", "gap_max_mean_final"} <= set(used)
    assert not [c for c in used if c.endswith(("_lt_g", "_st_g", "_early_g", "_own", "_st_s", "_std_final"))]


def test_both_kinds_of_segments_come_from_one_dealing(spark, monkeypatch):
    """Rows are dealt by range and written once for the numbers within users and within users' kinds of day."""
    rows = [(u, d, d % 7 > 4, float(d)) for u in ("a", "b", None) for d in range(40)]
    table = spark.createDataFrame(rows, "uuid string, date int, is_weekend boolean, Screen_w double").repartition(5)
    settled, settle = [], segments.settle
    monkeypatch.setattr(segments, "settle", lambda df, name: settled.append(name) or settle(df, name))
    got = segments.numbered(table, ["uuid"], "date", "user", [("kind", ["is_weekend"])]).collect()
    for r in got:
        mine = [x for x in rows if x[0] == r["uuid"] and x[1] < r["date"]]
        assert (r["user"], r["kind"]) == (len(mine), sum(x[2] == r["is_weekend"] for x in mine))
    assert len(got) == len(rows) and settled == ["ranges"]
    cfg = PipelineConfig(base_columns=("Screen",), segment_rows=7)
    cut = baseline.rolling_baselines(table, cfg)
    assert settled == ["ranges"] * 2
    whole = baseline.rolling_baselines(table, replace(cfg, segment_rows=None))
    assert cut.columns == whole.columns and sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_signals_and_their_differences_in_one_pass(spark, monkeypatch):
    """In segments the differences of a signal look back on two rows, from one numbering."""
    made = sorted({*DELTA_COLUMNS} - {"travel_signal_raw", "partial_signal_raw", "tz_change_signal"})
    rng = np.random.default_rng(5)
    rows = [(u, d, bool(rng.random() < 0.3), False, True, True, float(rng.integers(0, 9)), *map(float, rng.integers(0, 60, len(made)))) for u in "ab" for d in range(23)]
    names = "uuid string, date int, tz_changed boolean, qc_meta_retry_warn boolean, qc_meta_queue_warn boolean, meta_known boolean, unique_cell_cnt double"
    table = spark.createDataFrame(rows, ", ".join([names, *[f"{c} double" for c in made]])).withColumn("qc_core_very_low_activity", F.col("tz_changed"))
    settled, settle = [], segments.settle
    monkeypatch.setattr(segments, "settle", lambda df, name: settled.append(name) or settle(df, name))
    whole = features.add_signals_and_deltas(table)
    assert not settled and whole.where("travel_signal_raw_d1 <> 0").count() > 3
    for size in (1, 7):
        cut = features.add_signals_and_deltas(table, PipelineConfig(segment_rows=size)).select(*whole.columns)
        assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    assert settled == ["ranges"] * 2
