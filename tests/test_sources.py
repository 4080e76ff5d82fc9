"""Sources, sinks and runs: day tables, CSV files, made-up scenarios, event times, quantiles, the smoothed risk and the forest."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid import cli
from pulsegrid.config import PipelineConfig
from pulsegrid.functions.quantiles import exact_quantiles
from pulsegrid.operators import anomaly, features, risk
from pulsegrid.sources import csv_files, days
from pulsegrid.sources.events import standard_events
from pulsegrid.sources.synthetic import synthetic_events


def test_day_tables_are_read_by_range_and_replaced_by_day(spark, tmp_path):
    root = str(tmp_path / "t")
    assert days.read_range(spark, root, "2024-01-01", "2024-01-03") is None
    with pytest.raises(FileNotFoundError):
        days.read_day(spark, root, "2024-01-01")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-04", 5)):
        days.write_day(spark.range(n).withColumn("date", F.lit(day)), root, day)
    days.write_day(spark.range(7).withColumn("date", F.lit("2024-01-02")).withColumn("more", F.lit(1)), root, "2024-01-02")
    (tmp_path / "t" / "dt=2024-01-04" / "v=1" / "broken.parquet").write_bytes(b"not a table")
    assert days.read_day(spark, root, "2024-01-04").count() == 5
    assert days.read_lookback(spark, root, "2024-01-03", 2).count() == 7
    assert days.read_training(spark, root, "2024-01-03", 2).count() == 10
    both = days.read_range(spark, root, "2024-01-01", "2024-01-02")
    assert both.where("more is null").count() == 3 and both.count() == 10
    assert days.read_training(spark, root, "2023-01-01", 5) is None


def test_sinks_of_a_day_without_rows_write_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01", 1.0, True)], "uuid string, date string, x_mean_final double, baseline_ready boolean")
    assert not days.write_baseline(rows, str(tmp_path / "b"), "2024-01-02") and not (tmp_path / "b").exists()
    assert not days.write_state(rows, str(tmp_path / "s"), "2024-01-02") and not (tmp_path / "s").exists()
    assert days.write_baseline(rows, str(tmp_path / "b"), "2024-01-01") and days.write_state(rows, str(tmp_path / "s"), "2024-01-01")
    assert days.read_day(spark, str(tmp_path / "b"), "2024-01-01").columns == ["uuid", "date", "baseline_ready", "x_mean_final"]
    assert days.read_state(spark, str(tmp_path / "s"), "2024-01-01").count() == 1


def test_csv_files_of_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("uuid,sensor_id,ts_raw,Acc_Avg\nu,step,1700000000000,4\n")
    (tmp_path / "b.csv").write_text("Wifi_SSID,uuid,ts_raw,sensor_id\nhome,v,1700000000001,wifi_ssid\n")
    with pytest.warns(UserWarning):
        rows = csv_files.read_public(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "missing.csv")])
    got = {r["uuid"]: (r["event_name"], r["timestamp"], r["step_count"], r["wifi_ssid"]) for r in rows.collect()}
    assert got == {"u": ("STEP", "1700000000000", "4", None), "v": ("WIFI_SSID", "1700000000001", None, "home")}
    named = csv_files.read_csv_files(spark, [str(tmp_path / "a.csv")], user_from_name=True)
    assert [r["uuid"] for r in named.collect()] == ["a"]


@pytest.mark.parametrize("values", [[], [3.0], [1.0] * 50 + [2.0], np.random.default_rng(1).normal(size=997).tolist(), [None, 1.0, None, 4.0]])
def test_exact_quantiles(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(rows, {"x": F.col("x"), "none": F.lit(None).cast("double")}, [0.0, 0.005, 0.5, 0.9, 1.0]).first()
    known = [v for v in values if v is not None]
    assert (got["x_n"], got["none_n"], got["none_q"]) == (len(known), 0, [None] * 5)
    assert got["x_q"] == (pytest.approx(list(np.quantile(known, [0.0, 0.005, 0.5, 0.9, 1.0]))) if known else [None] * 5)


def test_smoothed_risk_of_a_long_series(spark):
    rng = np.random.default_rng(2)
    series = [None if rng.random() < 0.2 else float(rng.random()) for _ in range(600)]
    rows = spark.createDataFrame([("u", dt.date(2020, 1, 1) + dt.timedelta(days=i), v, i % 7 > 0) for i, v in enumerate(series)], "uuid string, date date, risk_adj double, scored boolean")
    mean, expected = None, []
    for i, v in enumerate(series):
        mean = mean if v is None else v if mean is None else 0.75 * mean + 0.25 * v
        expected.append(mean if i % 7 > 0 else None)
    got = [r["risk_score"] for r in risk.smoothed_risk(rows).orderBy("date").collect()]
    for g, e in zip(got, expected):
        assert g == (pytest.approx(e, rel=1e-12) if e is not None else None)


@pytest.mark.parametrize(
    ("column", "value", "day"),
    [("bigint", 1704067199000, dt.date(2024, 1, 1)), ("bigint", 1704067199, None), ("string", "2023-12-31 23:59:59", dt.date(2024, 1, 1)), ("string", "nonsense", None)],
)
def test_event_times(spark, column, value, day):
    raw = spark.createDataFrame([("u", "screen", value, 540)], f"uuid string, event_name string, timestamp {column}, tz_offset_minutes int")
    got = standard_events(raw).select("ms", "date", "event_cat").collect()
    if value == "nonsense":
        assert got == []
    else:
        assert (got[0]["ms"], got[0]["event_cat"]) == (1704067199000, "Screen")
        assert day is None or got[0]["date"] == day


def test_dates_are_utc_without_a_time_zone_column(spark):
    raw = spark.createDataFrame([("u", "SCREEN", 1704067199000)], "uuid string, event_name string, timestamp bigint")
    assert standard_events(raw).first()["date"] == dt.date(2023, 12, 31)


def test_synthetic_scenarios(spark):
    made = synthetic_events(spark, "2026-01-01", 12, normal=2, silent=1, travel=1, chaos=1)
    assert sorted(made.collect()) == sorted(synthetic_events(spark.newSession(), "2026-01-01", 12, normal=2, silent=1, travel=1, chaos=1).repartition(3).collect())
    daily = features.daily_features(standard_events(made.drop("dt")), PipelineConfig()).persist()
    kinds = {r["uuid"]: r["scenario"] for r in made.select("uuid", "scenario").distinct().collect()}
    for r in daily.collect():
        kind = kinds[r["uuid"]]
        if kind == "silent":
            assert not r["has_activity"]
        elif kind in ("normal", "chaos"):
            assert r["daily_event_cnt"] + r["unlock_cnt"] > 0 and r["Notif"] > 0 and not r["tz_changed"]
    assert daily.where("tz_changed").select("uuid").distinct().count() == 1


def test_forest_finds_planted_outliers_in_any_order(spark):
    rng = np.random.default_rng(4)
    z = rng.normal(size=(400, 3))
    z[:4] = 9 + rng.normal(size=(4, 3))
    data = [(f"u{i}", dt.date(2024, 1, 1), *map(float, v), True, True) for i, v in enumerate(z)]
    schema = "uuid string, date date, a_z double, b_z double, c_z double, scored boolean, baseline_fit boolean"
    cfg = PipelineConfig(trees=40)

    def scores(rows, c=cfg):
        df = spark.createDataFrame(rows, schema)
        return {r["uuid"]: r["anomaly_score_raw"] for r in anomaly.forest_scores(df, anomaly.train_forest(df, c), c).collect()}

    first = scores(data)
    assert set(sorted(first, key=first.get)[-4:]) == {"u0", "u1", "u2", "u3"}
    assert scores(data[::-1]) == pytest.approx(first)
    assert scores(data, PipelineConfig(trees=40, seed=7)) != first


def test_batch_and_training_runs(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("events", "daily", "model", "baselines", "states", "public.parquet")}
    made = synthetic_events(spark, "2026-01-01", 3, normal=3, silent=1, travel=0)
    made.drop("scenario").write.partitionBy("dt").parquet(at["events"])
    features.daily_features(standard_events(made.drop("dt", "scenario"))).write.parquet(at["public.parquet"])
    row = cli.run_training(spark, at["public.parquet"], at["model"], at["events"], "2026-01-02", 5, PipelineConfig(trees=5)).first()
    assert row["public_rows"] >= 12 and row["user_users"] == 4 and row["train_rows"] == row["public_rows"] + row["user_rows"]
    assert days.load_model(spark, at["model"]).count() > 0
    run = lambda: cli.run_batch(spark, *[at[n] for n in ("events", "daily", "model", "baselines", "states")], "2026-01-03")
    assert run() and run()  # a day run again is replaced
    states = days.read_state(spark, at["states"], "2026-01-03")
    assert states.count() == 4 == states.select("uuid").distinct().count()
    assert days.read_day(spark, at["baselines"], "2026-01-03").count() == 4
    with pytest.raises(FileNotFoundError):
        cli.run_batch(spark, *[at[n] for n in ("events", "daily", "model", "baselines", "states")], "2026-01-09")


def test_a_lost_write_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path / "t")
    days.write_day(spark.range(3), root, "2024-01-01")
    folder = days.day_folder(root, "2024-01-01")

    def lost(path):
        spark.range(9).write.parquet(path)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        days.publish(spark, folder, lost)
    assert days.read_day(spark, root, "2024-01-01").count() == 3 and days.versions(spark, folder) == [1]
    for n in (4, 5, 6, 7):
        days.write_day(spark.range(n), root, "2024-01-01")
    assert days.read_day(spark, root, "2024-01-01").count() == 7 and len(days.versions(spark, folder)) == days.KEPT + 1
    for n in (10, 20):
        days.save_model(spark.range(n).withColumnRenamed("id", "node"), str(tmp_path / "m"))
    assert days.load_model(spark, str(tmp_path / "m")).count() == 20 and days.load_model(spark, str(tmp_path / "m"), version=1).count() == 10
    with pytest.raises(FileNotFoundError):
        days.load_model(spark, str(tmp_path / "m"), version=7)
    spark.range(5).write.parquet(str(tmp_path / "t" / "dt=2024-01-02"))  # plain files of others
    assert days.read_range(spark, root, "2024-01-01", "2024-01-02").count() == 12


def test_public_features_are_those_of_the_first_file(spark, tmp_path):
    for name, n in (("b", 3), ("a", 2)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / f"w{name}"))
        next((tmp_path / f"w{name}").glob("part-*.parquet")).rename(tmp_path / f"{name}.parquet")
    assert days.public_features(spark, str(tmp_path)).count() == 2 and days.public_features(spark, str(tmp_path / "b.parquet")).count() == 3
    spark.range(11).repartition(3).write.parquet(str(tmp_path / "table"))
    assert days.public_features(spark, str(tmp_path / "table")).count() == 11
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        days.public_features(spark, str(tmp_path / "none"))


def test_many_csv_files_take_a_constant_number_of_jobs(spark, tmp_path):
    for i in range(300):
        head, row = (("uuid,ts_raw,sensor_id", f"u{i},{1700000000 + i},screen") if i % 2 else ("sensor_id,uuid,ts_raw", f'"screen",u{i},{1700000000000 + i}'))
        (tmp_path / f"f{i}.csv").write_text(f"{head}\n{row}\n" + ("only,two\n" if i == 7 else "") + ("a,b,c,d,e\n" if i == 8 else ""))
    (tmp_path / "empty.csv").write_text("")
    paths = [str(p) for p in sorted(tmp_path.glob("*.csv"))]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv", "csv")
    rows = csv_files.read_csv_files(spark, paths)
    jobs = len(tracker.getJobIdsForGroup("csv"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 8 and rows.count() == 300 and rows.select("uuid").distinct().count() == 300
    assert sorted(r["line"] for r in csv_files.broken_rows(spark, paths).collect()) == ["a,b,c,d,e", "only,two"]
    events = standard_events(csv_files.read_public(spark, paths))  # seconds and milliseconds, by user
    assert {r["date"] for r in events.select("date").collect()} == {dt.date(2023, 11, 14)} and events.count() == 300


def test_units_of_numbers_in_texts_are_those_of_their_user(spark):
    rows = [("s", "1704067199"), ("s", "1704067200"), ("m", "1704067199000"), ("m", "1704067200"), ("m", "1704067200000"), ("t", "2023-12-31 23:59:59"), ("t", "x"), ("d", "1704067199.5")]
    raw = spark.createDataFrame([(u, "screen", t) for u, t in rows], "uuid string, event_name string, ts_raw string")
    got = sorted((r["uuid"], r["ms"], str(r["date"])) for r in standard_events(raw).collect())
    assert got == [
        ("d", 1704067199000, "2023-12-31"), ("m", 1704067200, "1970-01-20"), ("m", 1704067199000, "2023-12-31"), ("m", 1704067200000, "2024-01-01"),
        ("s", 1704067199000, "2023-12-31"), ("s", 1704067200000, "2024-01-01"), ("t", 1704067199000, "2023-12-31"),
    ]


def test_heartbeats_are_dated_by_their_own_column(spark):
    day = 86_400_000
    rows = [("u", "screen", None, 10 * day, 10 * day), ("u", "beat", "Heartbeat", 10 * day, 12 * day), ("u", "HEARTBEAT", None, 10 * day, 13 * day), ("v", " heartbeat", None, 11 * day, None), ("v", "heartbeat", None, 11 * day, 14 * day)]
    raw = spark.createDataFrame(rows, "uuid string, event_name string, type string, ts_raw long, timestamp long")
    daily = features.daily_blocks(standard_events(raw, PipelineConfig(epoch_unit="ms")), PipelineConfig())
    got = {(r["uuid"], (r["date"] - dt.date(1970, 1, 1)).days): (r["has_activity"], r["heartbeat_cnt"]) for r in daily.collect()}
    assert got == {("u", 10): (True, None), ("u", 12): (False, 1), ("v", 14): (False, 1)}  # by type where a user has any, else by name


def test_late_events_are_merged_into_their_day(spark, tmp_path):
    """Batches by UTC date of users abroad and at home, with events that come days late, give what all events at once give."""
    at = {n: str(tmp_path / n) for n in ("events", "partials", "daily")}
    made = synthetic_events(spark, "2026-01-01", 4, normal=1, silent=1, travel=0, chaos=1).drop("scenario", "dt")
    made = made.withColumn("seq", F.row_number().over(cli.Window.partitionBy("uuid").orderBy("timestamp", "event_name", "queue_size", "retry_count", "step_count", "wifi_ssid", "cell_lac")))
    batch = F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400_000).cast("int"))
    late = F.when(F.pmod(F.xxhash64("uuid", "seq"), F.lit(40)) == 0, F.least(F.date_add(batch, 2), F.lit("2026-01-04").cast("date"))).otherwise(batch)
    made = made.withColumn("dt", late).persist()
    made.write.partitionBy("dt").parquet(at["events"])
    cfg = PipelineConfig(epoch_unit="ms", min_rhythm_events=20, min_gap_events=20)
    batches = sorted(str(r["dt"]) for r in made.select("dt").distinct().collect())
    for day in [*batches, batches[-2]]:  # one runs again
        cli.merge_batch(spark, at["events"], at["partials"], at["daily"], day, 10, cfg)
    got = {(r["uuid"], r["date"]): r for r in days.read_range(spark, at["daily"], "2025-12-25", "2026-01-10").collect()}
    whole = features.daily_features(standard_events(made.drop("dt"), cfg), cfg).collect()
    assert len(got) == len(whole) == days.read_range(spark, at["daily"], "2025-12-25", "2026-01-10").count()
    for r in whole:
        mine = got[(r["uuid"], r["date"])]
        for c, x in r.asDict().items():
            assert x == mine[c] or isinstance(x, float) and abs(x - mine[c]) < 1e-9, (r["uuid"], r["date"], c, x, mine[c])
