"""How often the steps of the event queries read, parse, sort and send a row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.config import PipelineConfig
from pulsegrid.operators import baseline, features, segments
from pulsegrid.plans import registry
from pulsegrid.sources.events import from_activity_log, standard_events


def test_rows_are_measured_in_their_order_over_batches(spark):
    """Batches of three rows give what gathered windows give; a row that is out of order is told."""
    rng = np.random.default_rng(4)
    rows = [(u, i, [None if rng.random() < 0.3 else float(v) for v in rng.normal(50, 9, 2)]) for u in range(4) for i in range(3 * u + 1)]
    rows[5] = (*rows[5][:2], [float("nan"), 1.0])
    table = spark.createDataFrame(rows, "u int, i long, x array<double>")
    frames, floors = ((6, 2), (3, 1)), (0.25, 0.75)
    gathered = [(u, i, [x for v, j, x in rows if v == u and j < i]) for u, i, _ in rows]
    want = spark.createDataFrame(gathered, "u int, i long, before array<array<double>>").select("u", "i", baseline.frame_stats(frames, floors)("before").alias("s"))
    key, most = lambda r: (r["u"], r["i"]), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        stats = baseline.running_stats(frames, floors)
        got = table.repartition(2, "u").sortWithinPartitions("u", "i").select("u", "i", stats("i", "x").alias("s")).collect()
        with pytest.raises(Exception, match="aren't in the order"):
            table.where("u = 3 and i <> 4").coalesce(1).select(stats("i", "x")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    for a, b in zip(sorted(got, key=key), sorted(want.collect(), key=key), strict=True):
        assert key(a) == key(b) and np.allclose(np.array(a["s"], float), np.array(b["s"], float), rtol=1e-12, equal_nan=True)


def test_baselines_send_a_row_once(spark):
    """Rows go to the workers with their own values, not with those of all rows before them."""
    table = spark.range(3).select(F.lit("u").alias("uuid"), F.col("id").cast("int").alias("date"), F.lit(False).alias("is_weekend"), F.lit(1.0).alias("Screen_w"))
    plan = baseline.rolling_baselines(table, PipelineConfig(base_columns=("Screen",)))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "row_number" in plan


def test_events_are_parsed_and_sorted_once(spark):
    """Properties are parsed in one place, and windows over a day's events share one order."""
    log = spark.createDataFrame([(1, "2024-01-01 00:00:00", 7, "view", 1.0, '{"k": 3}')], "event_id long, ts string, user_id long, event_type string, value double, props string")
    events = standard_events(from_activity_log(log.withColumn("ts", F.col("ts").cast("timestamp_ntz")), 8), PipelineConfig(epoch_unit="ms"))
    assert events._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1
    plan = features.day_states(events)[0]._jdf.queryExecution().sparkPlan().toString()
    orders = {line.split("Window [")[-1].split("windowspecdefinition(")[1].split(", specifiedwindowframe")[0] for line in plan.splitlines() if "Window [" in line}
    assert len(orders) == 1


def test_days_are_only_counted_where_a_user_has_so_many_events(spark):
    """Without a long user the look at the sizes takes no dates."""
    events = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3, "uuid string")
    assert segments.cut_days(events, 5, 1)[1] is False
    dated = spark.createDataFrame([("a", d, d) for d in range(6)], "uuid string, date int, ms long")
    assert segments.cut_days(dated, 5, 1)[1] is False and segments.cut_days(dated.withColumn("date", F.lit(1)), 5, 1)[1] is True


def test_names_are_stripped_as_by_the_pattern(spark):
    names = ["view", " view", "view \n", "a b", "\tx\x0b\f\r", "y\x85", "y \x85", "z  ", " w", "", " ", None, "q \n\n", "\x1cv\x1c"]
    log = spark.createDataFrame([("u", i, n) for i, n in enumerate(names)], "uuid string, timestamp long, event_name string")
    want = log.select(F.upper(F.regexp_replace("event_name", r"^\s+|\s+$", "")).alias("n"), "timestamp").orderBy("timestamp").collect()
    got = standard_events(log, PipelineConfig(epoch_unit="ms")).orderBy("ms").collect()
    assert [r["event_std"] for r in got] == [r["n"] for r in want]


def test_the_forest_is_kept_with_what_risks_take(spark, monkeypatch):
    """The table of anomaly scores doesn't write the rolling baselines again."""
    rows = spark.createDataFrame([("u", 1, 0.5, True, True, 1.0, 1.0)], "uuid string, date int, Screen_z double, scored boolean, baseline_fit boolean, Screen_mean_lt_g double, Screen_std_st_s double")
    monkeypatch.setattr(registry, "_scored", lambda *a: rows)
    monkeypatch.setattr(registry, "settle", lambda df, name: df)
    monkeypatch.setattr(registry, "_kept", {})
    monkeypatch.setattr(registry.anomaly, "train_forest", lambda *a: None)
    monkeypatch.setattr(registry.anomaly, "forest_scores", lambda df, *a: df.withColumn("anomaly_score_raw", F.lit(0.5)))
    made = registry._forest(spark, "/root/testdata/sf0.001").columns
    assert set(made) == {"uuid", "date", "Screen_z", "scored", "baseline_fit", "anomaly_score_raw", "anomaly_score", "anomaly_flag"}
