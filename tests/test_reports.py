"""Reports, exports and training on tables of other shapes."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from pulsegrid import cli
from pulsegrid.config import PipelineConfig
from pulsegrid.operators import baseline, features, reports
from pulsegrid.sources import days
from pulsegrid.sources.events import standard_events


def public_like(spark, days_: int = 30):
    """Users of public files: screens and actions, nothing that makes a session or a move."""
    rng = random.Random(6)
    start = 1_704_067_200_000
    rows = [
        (user, i, rng.choice(("SCREEN", "USERACT")), start + day * 86_400_000 + rng.randrange(86_400_000))
        for user in "abc" for day in range(days_) for i in range(60 + rng.randrange(20))
    ]
    return spark.createDataFrame(rows, "uuid string, seq long, event_name string, timestamp long")


def test_a_table_without_sessions_is_scored(spark, tmp_path):
    daily = features.daily_features(standard_events(public_like(spark)))
    daily.write.parquet(str(tmp_path / "public.parquet"))
    kept = spark.read.parquet(str(tmp_path / "public.parquet"))
    assert set(baseline.present_columns(kept)) == set(PipelineConfig().base_columns) - {"session_total_sec", "session_cnt", "step_sum"}
    without = kept.drop(*[f"has_{b}" for b in features.BLOCKS if b != "activity"], *features.BLOCKS["session"], *features.BLOCKS["mobility"], "tz_change_signal")
    for table in (kept, without):
        scored = baseline.baselines(table)
        got = scored.agg(F.count("*").alias("n"), F.count_if("scored").alias("scored"), F.count("Screen_z").alias("z")).first()
        assert got["n"] == 90 and got["scored"] >= 0.6 * 90 and got["z"] == got["scored"] and "session_cnt_mean_lt_g" not in scored.columns
    one_session = kept.withColumn("has_session", (F.col("uuid") == "a") & (F.col("date") == dt.date(2024, 1, 1)))
    assert baseline.baselines(one_session).where("scored").isEmpty()  # a block that any user has is asked for of all
    cli.run_training(spark, str(tmp_path / "public.parquet"), str(tmp_path / "m"), cfg=PipelineConfig(trees=8))
    forest = days.load_model(spark, str(tmp_path / "m"))
    assert forest.where("feature >= 0").select("threshold").distinct().count() > 20  # grown from z-scores, not from blanks


def test_forest_sampling_makes_few_rows(spark):
    from pulsegrid.operators import anomaly

    cfg = PipelineConfig(trees=20, tree_rows=64)
    for n in (40, 3000, 40_000):
        rows = spark.range(n).select(F.col("id").cast("string").alias("uuid"), F.lit(dt.date(2024, 1, 1)).alias("date"), F.randn(1).alias("a_z"), F.randn(2).alias("b_z"), F.lit(True).alias("scored"), F.lit(True).alias("baseline_fit"))
        made = anomaly.entries(rows, n, cfg).groupBy("tree").count().collect()
        assert len(made) == 20 and sum(r["count"] for r in made) <= 5 * 20 * 64 and min(r["count"] for r in made) >= min(n, 64)
        roots = anomaly.train_forest(rows, cfg).where("node = 1").collect()
        assert [r["rows"] for r in roots] == [min(n, 64)] * 20


def test_bucketed_tables_are_joined_where_they_lie(spark):
    left = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None), ("c", 3, 0.7)], "uuid string, day int, risk double")
    right = spark.createDataFrame([("a", 10, True), ("c", 11, False), ("d", 12, None)], "uuid string, day int, ready boolean")
    got = reports.cross_check(reports.bucketed(left, ["uuid"], 4), reports.bucketed(right, ["uuid"], 4))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [("a", 1, 0.5, 10, True), ("b", 2, None, None, None), ("c", 3, 0.7, 11, False)]
    assert {r["ready"]: (r["n"], r["mean"]) for r in reports.mean_by_flag(got, "ready", "risk").collect()} == {True: (1, 0.5), False: (1, 0.7), None: (1, None)}


def test_rows_of_a_day_once(spark):
    rows = spark.createDataFrame([("a", "d", 1, "x"), ("a", "d", 2, "y"), ("b", "d", 1, "z")], "uuid string, date string, seq int, v string")
    assert sorted(r["v"] for r in reports.unique_days(rows, "seq").collect()) == ["y", "z"]
    assert reports.unique_days(rows.drop("date"), "seq").count() == 3


def test_filters_of_events(spark):
    events = spark.createDataFrame([("STEP", "s"), ("STEP_COUNT", "t"), (None, "STEP")], "event_std string, sensor_id string")
    assert [r[0] for r in reports.by_names(events, ["STEP"]).collect()] == ["STEP"]
    assert [r[0] for r in reports.by_names(events.drop("event_std"), ["STEP"]).collect()] == ["STEP"]
    assert reports.by_names(events.select(F.lit(1).alias("x")), ["STEP"]).count() == 0
    assert sorted(r[0] for r in reports.by_prefix(events, ["STEP_", "X"]).collect()) == ["STEP_COUNT"] and reports.by_prefix(events, []).count() == 0


def test_exports_have_their_order_and_a_mark(spark, tmp_path):
    daily = features.daily_features(standard_events(public_like(spark, 2)))
    days.write_export(daily, str(tmp_path / "f"))
    files = [p for p in Path(tmp_path / "f").glob("*.csv") if p.stat().st_size]
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfuuid,date,Screen,") for p in files)
    table = pd.concat(pd.read_csv(p, encoding="utf-8-sig") for p in files)
    assert len(table) == daily.count() and list(table.columns[:8]) == list(days.EXPORT_ORDER[:8]) and table.columns[-1].endswith("_r1")
    days.write_export(daily.select("date", "uuid"), str(tmp_path / "g"), ())
    assert [p for p in Path(tmp_path / "g").glob("*.csv") if p.read_bytes().startswith(b"\xef\xbb\xbfdate,uuid")]


def test_descriptions_of_empty_and_constant_columns(spark):
    rows = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "a double, b double")
    got = {r["feature"]: r for r in reports.describe_columns(rows, ["a", "b"]).collect()}
    assert (got["a"]["n"], got["a"]["mean"], got["a"]["std"], got["a"]["p95"]) == (3, 1.0, 0.0, 1.0)
    assert (got["b"]["n"], got["b"]["mean"], got["b"]["p50"], got["b"]["high"]) == (0, None, None, None)
