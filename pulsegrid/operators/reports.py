"""Reports over features, model output and states."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pulsegrid.functions.columns import top_by_abs
from pulsegrid.functions.quantiles import exact_quantiles
from pulsegrid.sources.tables import shared_folder


def by_user() -> WindowSpec:
    return Window.partitionBy("uuid").orderBy("date")


def missing_rates(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """Columns with the largest share of nulls."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "feature", "missing_rate").orderBy(F.desc("missing_rate"), "feature").limit(k)


#: Rows that break these are suspect.
CHECKS = {
    "night_ratio": "night_ratio < 0 or night_ratio > 1",
    "day_ratio": "day_ratio < 0 or day_ratio > 1",
    "evening_ratio": "evening_ratio < 0 or evening_ratio > 1",
    "peak_ratio": "peak_ratio < 0 or peak_ratio > 1",
    "gap_long_ratio": "gap_long_ratio < 0 or gap_long_ratio > 1.5",
    "peak_hour": "peak_hour < 0 or peak_hour > 23",
    "first_hour": "first_hour < 0 or first_hour > 23",
    "last_hour": "last_hour < 0 or last_hour > 23",
    "overnight_gap": "overnight_gap < 0",
    "gap_max": "gap_max < 0",
    "gap_p95": "gap_p95 < 0",
    "session_total_sec": "session_total_sec < 0",
    "session_cnt": "session_cnt < 0",
    "session_mean_sec": "session_mean_sec < 0",
    "heartbeat_cnt": "heartbeat_cnt < 0",
    "retry_max": "retry_max < 0",
    "queue_max": "queue_max < 0",
    "tz_offset": "tz_offset_min < -720 or tz_offset_max > 840",
    "core_sum": "daily_event_cnt <> Screen + UserAct",
}


def range_checks(features: DataFrame) -> DataFrame:
    """Number of rows that break each range or sum rule."""
    one = features.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in CHECKS.items()])
    return one.unpivot([], list(CHECKS), "rule", "violations")


def transition_matrix(states: DataFrame) -> DataFrame:
    """Counts of state changes from day to day with margins ('ALL')."""
    moves = states.select(F.lag("cat_state").over(by_user()).alias("prev"), F.col("cat_state").alias("cur")).where("prev is not null")
    counts = moves.cube("prev", "cur").agg(F.count("*").alias("n"))
    return counts.select(F.coalesce("prev", F.lit("ALL")).alias("prev"), F.coalesce("cur", F.lit("ALL")).alias("cur"), "n")


def top_transitions(states: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent pairs of a day's state and the one before; ties by name."""
    moves = states.select(F.lag("cat_state").over(by_user()).alias("prev"), F.col("cat_state").alias("cur")).where("prev is not null")
    return moves.groupBy("prev", "cur").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "prev", "cur").limit(k)


def top_z_by_state(states: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent top features of each pattern state, on days the decoder is sure of."""
    rows = states.where("decoder_quality = 'OK' and cat_state in ('SLEEP', 'LETHARGY', 'CHAOS', 'STABLE')")
    counts = rows.groupBy("cat_state", "top_z_feature").agg(F.count("*").alias("n"))
    order = Window.partitionBy("cat_state").orderBy(F.desc("n"), "top_z_feature")
    return counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def with_alarms(model: DataFrame, q: float = 0.99) -> DataFrame:
    """The rows that have a risk score, and whether it reaches the ``q`` quantile of all."""
    valid = model.where("risk_score is not null")
    top = exact_quantiles(valid, {"r": F.col("risk_score")}, [q]).select(F.get("r_q", F.lit(0)).alias("top"))
    return valid.crossJoin(F.broadcast(top)).withColumn("alarm", F.col("risk_score") >= F.col("top"))  # one row


def risk_thresholds(model: DataFrame) -> DataFrame:
    """One row: the risk scores from which a day is an alarm, and a severe one."""
    found = exact_quantiles(model, {"r": F.col("risk_score")}, [0.99, 0.998])
    return found.select(F.get("r_q", F.lit(0)).alias("top"), F.get("r_q", F.lit(1)).alias("severe"))


def alarm_runs(model: DataFrame) -> DataFrame:
    """First date and length of each run of alarms among a user's days with a risk score."""
    rows = with_alarms(model).select("uuid", "date", "alarm")
    rows = rows.withColumn("calm", F.sum((~F.col("alarm")).cast("int")).over(by_user()))  # the same within a run
    return rows.where("alarm").groupBy("uuid", "calm").agg(F.min("date").alias("first_date"), F.count("*").alias("days")).drop("calm")


def user_mode_state(states: DataFrame) -> DataFrame:
    """Each user's most frequent state, the first by name among equals."""
    counts = states.groupBy("uuid", "cat_state").agg(F.count("*").alias("n"))
    best = counts.groupBy("uuid").agg(F.min(F.struct((-F.col("n")).alias("m"), "cat_state")).alias("b"))
    return best.select("uuid", F.col("b.cat_state").alias("mode_state"))


def distribution(states: DataFrame, column: str) -> DataFrame:
    """Counts and shares of a column's values."""
    counts = states.groupBy(column).agg(F.count("*").alias("n"))
    total = states.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(F.col(column), "n", (F.col("n") / F.col("total")).alias("share"))


QUANTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row a column: count, mean, deviation, least, quantiles and largest of its values."""
    x = {c: F.col(c).cast("double") for c in columns}
    facts = {"mean": F.avg, "std": F.stddev_samp, "low": F.min, "high": F.max}
    one = df.agg(*[f(v).alias(f"{c}_{n}") for c, v in x.items() for n, f in facts.items()])
    both = one.crossJoin(F.broadcast(exact_quantiles(df, x, list(QUANTILES.values()))))  # one row each

    def row(c: str):
        q = [F.get(f"{c}_q", F.lit(i)).alias(n) for i, n in enumerate(QUANTILES)]
        return F.struct(F.lit(c).alias("feature"), F.col(f"{c}_n").alias("n"), *[F.col(f"{c}_{n}").alias(n) for n in ("mean", "std", "low")], *q, F.col(f"{c}_high").alias("high"))

    return both.select(F.inline(F.array(*[row(c) for c in columns])))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, moments and quantiles of a column: one row."""
    return describe_columns(df, [column]).drop("feature")


def component_correlation(model: DataFrame, components: tuple[str, ...] = ("z_score", "a_score"), least: int = 30) -> DataFrame:
    """Correlation of the risk score with each of its components, where more than ``least`` rows have both."""
    pairs = model.select("risk_score", F.explode(F.create_map(*[x for c in components for x in (F.lit(c), F.col(c))])).alias("component", "value"))
    pairs = pairs.where("risk_score is not null and value is not null")
    return pairs.groupBy("component").agg(F.count("*").alias("pairs"), F.when(F.count("*") > least, F.corr("risk_score", "value")).alias("corr"))


def top_risk(model: DataFrame, k: int = 200) -> DataFrame:
    """The days with the highest risk score; ties by user and date."""
    return model.where("risk_score is not null").orderBy(F.desc("risk_score"), "uuid", "date").limit(k)


def top_z_frequency(model: DataFrame, z: list[str], k: int = 200, most: int = 15) -> DataFrame:
    """How often each z-score is the largest, relative to its median size on scored days, on the days of highest risk.

    A median of zero or none counts as one; the first column wins among equals.
    """
    scored = model.where("quality_state = 'GOOD' and baseline_ready")
    middle = exact_quantiles(scored, {c: F.abs(c) for c in z}, [0.5])
    middle = middle.select(*[F.coalesce(F.nullif(F.get(f"{c}_q", F.lit(0)), F.lit(0.0)), F.lit(1.0)).alias(f"_{c}") for c in z])
    days = top_risk(model, k).crossJoin(F.broadcast(middle))  # one row
    top = top_by_abs([(c, F.col(c) / F.col(f"_{c}")) for c in z])["name"]
    counts = days.select(top.alias("feature")).where("feature is not null").groupBy("feature").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "feature").limit(most)


def alarm_rates(model: DataFrame) -> DataFrame:
    """Share of alarms among each user's days with a risk score."""
    return with_alarms(model).groupBy("uuid").agg(F.avg(F.col("alarm").cast("double")).alias("alarm_rate"))


def duplicate_keys(df: DataFrame) -> DataFrame:
    """(uuid, date) that occur more than once, with their number."""
    return df.groupBy("uuid", "date").agg(F.count("*").alias("n")).where("n > 1")


def keep_last(df: DataFrame, order: str) -> DataFrame:
    """The last row of each (uuid, date) in the given order."""
    return df.groupBy("uuid", "date").agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def mean_by_flag(rows: DataFrame, flag: str, column: str) -> DataFrame:
    """Rows and the column's mean for each value of a flag."""
    return rows.groupBy(flag).agg(F.count("*").alias("n"), F.avg(column).alias("mean"))


def distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n, share): how often each value of the columns occurs, a null as 'null'."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).groupBy("feature", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("feature")))


def null_counts(df: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """Columns with the most nulls."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "nulls").orderBy(F.desc("nulls"), "feature").limit(k)


def flag_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of true values among those that are known."""
    one = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in flags])
    return one.unpivot([], list(flags), "feature", "rate")


def suspect_days(features: DataFrame, k: int = 10) -> DataFrame:
    """The first days with heartbeats but no activity, or with a sign of partial collection."""
    odd = (F.col("daily_event_cnt") == 0) & (F.coalesce("heartbeat_cnt", F.lit(0)) > 0) | (F.coalesce("partial_signal_raw", F.lit(0.0)) > 0)
    shown = ("daily_event_cnt", "heartbeat_cnt", "partial_signal_raw", "travel_signal_raw", "gap_max", "gap_cnt_6h", "night_ratio", "hour_entropy")
    return features.where(odd).select("uuid", "date", *shown).orderBy("uuid", "date").limit(k)


def notify_coverage(states: DataFrame) -> DataFrame:
    """One row: users, those with any notification, and their share."""
    users = states.groupBy("uuid").agg(F.max(F.col("notify_level") != "NONE").alias("told"))
    return users.agg(F.count_if("told").alias("told"), F.count("*").alias("users"), F.avg(F.col("told").cast("double")).alias("share"))


def bucketed(rows: DataFrame, keys: Sequence[str], buckets: int = 16) -> DataFrame:
    """The rows as a table dealt and sorted by the keys, in the shared folder; such tables are joined where they lie."""
    spark, name = rows.sparkSession, f"pulsegrid_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def cross_check(states: DataFrame, baselines: DataFrame, keys: Sequence[str] = ("uuid",), suffix: str = "_b") -> DataFrame:
    """Each state with its baseline, if it has one; columns that both have come twice, the baseline's with the suffix."""
    other = baselines.withColumnsRenamed({c: f"{c}{suffix}" for c in baselines.columns if c in states.columns})
    on = [states[k] == other[f"{k}{suffix}"] for k in keys]
    return states.join(other.hint("merge"), on, "left").drop(*[f"{k}{suffix}" for k in keys])


def has_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    return set(columns) <= set(df.columns)


def unique_days(df: DataFrame, order: str) -> DataFrame:
    """The last row of each user's day, where the table has users and days; else as it is."""
    return keep_last(df, order) if has_columns(df, ("uuid", "date")) else df


def by_names(events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Events of these names, or of these sensors where the table has no names."""
    column = "event_std" if "event_std" in events.columns else "sensor_id"
    return events.where(F.col(column).isin(*names)) if column in events.columns else events.limit(0)


def by_prefix(events: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Events whose name begins with one of the prefixes."""
    begins = F.lit(False)
    for p in prefixes:
        begins = begins | F.coalesce(F.col("event_std").startswith(p), F.lit(False))
    return events.where(begins)
