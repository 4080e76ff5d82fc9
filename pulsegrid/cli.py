"""Daily batch and training runs: ``python -m pulsegrid.cli batch|train --help``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.config import PipelineConfig
from pulsegrid.operators import anomaly, baseline, decoder, features, risk
from pulsegrid.sources import days
from pulsegrid.sources.events import standard_events
from pulsegrid.sources.tables import settle


def merge_batch(spark: SparkSession, events: str, partials: str, daily: str, day: str, lookback: int = 31, cfg: PipelineConfig = PipelineConfig()) -> list[dt.date]:
    """Adds one day's batch of events to the partial states of its users' days, and brings the daily features up to date; the days that were written.

    A batch may hold events of days before its own.  Its states are kept beside those of the other batches
    and put together by user and day, so a late event changes the row of its day and adds none.  All
    days from the earliest changed one on are written, as a day's features look back on the user's days before.
    States of a user's day that overlap in time can't be put together in order: these few days
    are counted again from the events of their batches.
    """
    states, _ = features.day_states(standard_events(days.read_day(spark, events, day), cfg), cfg)
    days.write_day(states, partials, day)
    first = days.read_day(spark, partials, day).agg(F.min("date")).first()[0]
    if first is None:
        return []
    reach = dt.timedelta(days=lookback - 1)  # batches that may hold events of the same days, later ones too where a batch runs again
    around = (days.as_day(day) - reach, days.as_day(day) + reach)
    held = settle(days.read_range(spark, partials, *around), "partials")
    order = Window.partitionBy("uuid", "date").orderBy("from_ms", "to_ms")
    before = F.max("to_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    mixed = settle(held.withColumn("_before", before).where(F.col("from_ms") <= F.col("_before")).select("uuid", "date").distinct(), "mixed")
    if not mixed.isEmpty():
        raw = days.read_range(spark, events, *around)
        again = standard_events(raw, cfg)
        dated = "beat_date" if "beat_date" in again.columns else "date"
        near = again.join(mixed.select(F.col("uuid").alias("_u"), F.col("date").alias("_d")), (F.col("uuid") == F.col("_u")) & ((F.col("date") == F.col("_d")) | (F.col(dated) == F.col("_d"))), "left_semi")
        fresh, _ = features.day_states(near, cfg)
        held = held.join(mixed, ["uuid", "date"], "left_anti").unionByName(fresh.join(mixed, ["uuid", "date"], "left_semi"))
    whole = settle(features.features_of_blocks(features.blocks_of_states(held, True, cfg), cfg), "features")
    last = whole.agg(F.max("date")).first()[0]
    written = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    for d in written:
        rows = whole.where(F.col("date") == F.lit(d))
        if not rows.isEmpty():
            days.write_day(rows, daily, d)
    return written


def run_batch(
    spark: SparkSession, events: str, daily: str, model: str, baselines: str, states: str, day: str, lookback: int = 31, cfg: PipelineConfig = PipelineConfig(), partials: str | None = None
) -> bool:
    """One day: its events become daily features, which with the days before give baselines and states of that day.

    All day tables are replaced for the day only, so a run can be repeated.  With ``partials``, late events
    are merged into the rows of their days (:func:`merge_batch`); without, a batch's features are its own and
    an event of another day makes a row of its own.  False where the day has no states.
    """
    if partials:
        merge_batch(spark, events, partials, daily, day, lookback, cfg)
    else:
        days.write_day(features.daily_features(standard_events(days.read_day(spark, events, day), cfg), cfg), daily, day)
    rows = settle(baseline.baselines(days.read_lookback(spark, daily, day, lookback), cfg), "baselines")
    days.write_baseline(rows, baselines, day)
    scaled = anomaly.scale_by_user(anomaly.forest_scores(rows, days.load_model(spark, model), cfg), cfg)
    decoded = settle(decoder.decode(risk.model_output(risk.risk_table(scaled, cfg)), cfg), "states")
    return days.write_state(decoded, states, day)


def _sizes(prefix: str, rows: DataFrame | None) -> dict[str, int]:
    if rows is None:
        return {f"{prefix}_rows": 0, f"{prefix}_users": 0, f"{prefix}_cols": 0}
    n = rows.agg(F.count("*").alias("rows"), F.count_distinct("uuid").alias("users")).first()
    return {f"{prefix}_rows": n["rows"], f"{prefix}_users": n["users"], f"{prefix}_cols": len(rows.columns)}


def run_training(
    spark: SparkSession, public: str, model: str, events: str | None = None, as_of: str | None = None, lookback: int = 30, cfg: PipelineConfig = PipelineConfig()
) -> DataFrame:
    """Grows a forest on public daily features and, where there are any, on those of the last days' events; a row of parameters and sizes.

    The model at ``model`` gets a new version.
    """
    end = days.as_day(as_of) if as_of else days.today(cfg.default_tz_minutes) - dt.timedelta(days=1)
    known = days.public_features(spark, public)
    raw = days.read_training(spark, events, end, lookback) if events else None
    own = settle(features.daily_features(standard_events(raw, cfg), cfg), "features") if raw is not None else None
    both = known if own is None else known.unionByName(own, allowMissingColumns=True)
    rows = settle(baseline.baselines(both, cfg), "training")
    path = days.save_model(anomaly.train_forest(rows, cfg), model)
    row = {"as_of": str(end), "cutoff": str(end - dt.timedelta(days=lookback)), "lookback_days": lookback, "public": public, "events": events or "", "model": path}
    row |= _sizes("public", known) | _sizes("user", own) | _sizes("train", both)
    return spark.createDataFrame([tuple(row.values())], list(row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pulsegrid")
    runs = parser.add_subparsers(dest="run", required=True)
    batch, train = runs.add_parser("batch"), runs.add_parser("train")
    for name in ("events", "daily", "model", "baselines", "states"):
        batch.add_argument(f"--{name}", required=True)
    batch.add_argument("--day", default=None, help="YYYY-MM-DD; today, if not given")
    batch.add_argument("--lookback", type=int, default=31)
    batch.add_argument("--partials", default=None, help="folder of partial states; late events are merged into their days with it")
    for name in ("public", "model"):
        train.add_argument(f"--{name}", required=True)
    train.add_argument("--events", default=None)
    train.add_argument("--as-of", default=None, help="YYYY-MM-DD; yesterday, if not given")
    train.add_argument("--lookback", type=int, default=30)
    train.add_argument("--metrics", default=None, help="folder that a row of sizes is appended to")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("pulsegrid").getOrCreate()
    if a.run == "batch":
        run_batch(spark, a.events, a.daily, a.model, a.baselines, a.states, a.day or str(days.today()), a.lookback, partials=a.partials)
        return
    row = run_training(spark, a.public, a.model, a.events, a.as_of, a.lookback)
    if a.metrics:
        row.write.mode("append").json(a.metrics)


if __name__ == "__main__":
    main()
