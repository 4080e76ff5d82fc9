"""Risk from z-scores and anomaly, cold-start risk, recovery and drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.config import DRIFT_COLUMNS, Z_GROUPS, PipelineConfig
from pulsegrid.functions.columns import clip, row_quantile, top_by_abs, trim_mean
from pulsegrid.functions.quantiles import exact_quantiles
from pulsegrid.operators.baseline import soft_z
from pulsegrid.operators.segments import of_key, smoothed, windowed
from pulsegrid.sources.tables import settle


def group_representatives(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds a high quantile of each group's absolute z-scores, their trimmed mean, and the largest of all."""
    reps = {}
    for group, cols in Z_GROUPS.items():
        z = [f"{c}_z" for c in cols if f"{c}_z" in rows.columns]
        if z:
            q = cfg.core_quantile if group == "core" else cfg.other_quantile
            reps[f"z_{group}_rep"] = row_quantile(F.array(*[F.abs(c) for c in z]), q)
    rows = rows.withColumns(reps)
    every = F.array(*[F.abs(c) for c in rows.columns if c.endswith("_z")])
    return rows.withColumns({"z_trim_mean_abs": trim_mean(F.array(*[F.col(c) for c in reps])), "z_max_abs": F.array_max(every)})


def _with_scale(rows: DataFrame, column: str, mask: str, name: str) -> DataFrame:
    """Adds the column's upper decile over the masked rows (one row, broadcast)."""
    rows = settle(rows, name)  # read twice
    upper = exact_quantiles(rows, {"x": F.when(F.col(mask), F.col(column))}, [0.9])
    tau = F.greatest(F.coalesce(F.col("x_q")[0], F.lit(1.0)), F.lit(1e-6))
    return rows.crossJoin(F.broadcast(upper.select(tau.alias(name))))


def daily_risk(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds z_score, a_score, risk_pre and risk_adj (discounted by context) on scored days."""
    rows = _with_scale(rows, "z_trim_mean_abs", "scored", "tau")
    z = clip(1 - F.exp(-F.col("z_trim_mean_abs") / (F.col("tau") + 1e-6)), 0.0, 0.999)
    discounts = [F.when(F.array_contains(F.split("context_mode", "[|]"), k), F.lit(v)).otherwise(F.lit(1.0)) for k, v in cfg.discount.items()]
    rows = rows.withColumns({"z_score": z, "a_score": clip(F.col("anomaly_score"), 0.0, 0.999)})
    pre = F.when(F.col("scored"), clip(cfg.weight_z * F.col("z_score") + cfg.weight_a * F.col("a_score"), 0.0, 1.0))
    return rows.withColumn("risk_pre", pre).withColumn("risk_adj", F.col("risk_pre") * F.least(*discounts))


def smoothed_risk(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds risk_score, the exponential mean of the user's risk_adj so far; days without one don't move it.

    The affine maps of the days are folded in segments, so a series of any length takes linear time and
    every value counts, however small its weight.
    """
    rows = smoothed(rows, ["uuid"], "date", "risk_adj", cfg.ema_alpha, "_mean", cfg.segment_rows)
    return rows.withColumn("risk_score", F.when(F.col("scored"), F.col("_mean"))).drop("_mean")


def early_risk(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds early_risk on good days of the cold start, and final_risk = risk_score, else early_risk."""
    mask = (F.col("quality_state") == "GOOD") & F.col("cold_stage").isin("WARMUP", "SEMI_READY") & F.col("early_ready")
    rows = rows.withColumn("early_day", mask)
    z = {
        c: F.abs(F.when(F.col("early_day"), soft_z(F.col(c).cast("double"), F.col(f"{c}_mean_early_s"), F.col(f"{c}_std_early_s"), cfg.z_clip)))
        for c in cfg.base_columns
        if f"{c}_mean_early_s" in rows.columns  # those that the table has
    }
    rows = rows.select("*", *[v.alias(f"_{c}_early") for c, v in z.items()])
    rows = settle(rows, "early")  # read twice
    middle = exact_quantiles(rows, {c: F.col(f"_{c}_early") for c in z}, [0.5])
    middle = middle.select(*[F.coalesce(F.nullif(F.col(f"{c}_q")[0], F.lit(0.0)), F.lit(1.0)).alias(f"_{c}_mid") for c in z])
    rows = rows.crossJoin(F.broadcast(middle))  # one row
    rows = rows.withColumn("z_trim_mean_abs_early", trim_mean(F.array(*[F.col(f"_{c}_early") / F.col(f"_{c}_mid") for c in z])))
    rows = rows.drop(*[f"_{c}_{x}" for c in z for x in ("early", "mid")])
    rows = _with_scale(rows, "z_trim_mean_abs_early", "early_day", "tau_early")
    scale = F.col("tau_early") + 1e-6
    raw, most = 1 - F.exp(-F.col("z_trim_mean_abs_early") / scale), 1 - F.exp(-F.lit(cfg.z_clip) / scale)
    rows = rows.withColumn("early_risk", F.when(F.col("early_day"), clip(raw / (most + 1e-6), 0.0, 1.0)))
    return rows.withColumn("final_risk", F.coalesce("risk_score", "early_risk"))


def recovery(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds bad_history_flag (a high risk among the days before) and stable_hold_flag (low again after that)."""

    def history(df: DataFrame, part: list[str]) -> DataFrame:
        before = Window.partitionBy(*part).orderBy("date").rowsBetween(-cfg.hold_window, -1)
        bad = (F.count("final_risk").over(before) >= cfg.hold_least) & (F.max("final_risk").over(before) >= cfg.bad_risk)
        return df.withColumn("bad_history_flag", F.coalesce(bad, F.lit(False)))

    rows = windowed(rows, ["uuid"], "date", cfg.hold_window, history, cfg.segment_rows)
    return rows.withColumn("stable_hold_flag", F.col("bad_history_flag") & F.coalesce(F.col("final_risk") < cfg.stable_risk, F.lit(False)))


def drift(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds <column>_drift: the baseline's distance from the anchor days, and drift_flag and drift_top_feature after them."""
    first, last = cfg.anchor_days
    anchor = F.col("day_idx").between(first, last) & F.col("baseline_fit")
    watched = [c for c in DRIFT_COLUMNS if f"{c}_mean_final" in rows.columns]
    anchors = {f"_{c}_{n}": f(F.when(anchor, F.col(c).cast("double"))) for c in watched for n, f in (("avg", F.avg), ("std", F.stddev_samp))}
    rows = of_key(rows if cfg.segment_rows is None else settle(rows, "risk"), ["uuid"], anchors, cfg.segment_rows)

    def distance(c: str) -> Column:
        std = F.col(f"_{c}_std")
        return (F.col(f"{c}_mean_final") - F.col(f"_{c}_avg")) / F.when(std.isNotNull(), F.greatest(std, F.lit(cfg.floor(c))))

    rows = rows.select("*", *[distance(c).alias(f"{c}_drift") for c in watched])
    top = top_by_abs([(c, F.col(f"{c}_drift")) for c in watched])
    rows = rows.withColumn("_top", top)
    flag = (F.col("day_idx") > last) & F.coalesce(F.col("_top.size") >= cfg.drift_z, F.lit(False))
    return rows.withColumns({"drift_flag": flag, "drift_top_feature": F.when(flag, F.col("_top.name")).otherwise("")}).drop("_top", *anchors)


def risk_inputs(scaled: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The columns that risks are computed from or exported with; the other baselines aren't written again at every step."""
    used = {*MODEL_COLUMNS, "scored", "baseline_fit", *cfg.base_columns, *DRIFT_COLUMNS}
    used |= {f"{c}_{x}_early_s" for c in cfg.base_columns for x in ("mean", "std")} | {f"{c}_mean_final" for c in DRIFT_COLUMNS}
    return scaled.select(*[f"`{c}`" for c in scaled.columns if c in used or c.endswith("_z")])


def risk_table(scaled: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """All risk columns from rows with z-scores and a scaled anomaly."""
    steps = (risk_inputs, group_representatives, daily_risk, smoothed_risk, early_risk, recovery, drift)
    return reduce(lambda df, step: step(df, cfg), steps, scaled)


MODEL_COLUMNS = (
    "uuid", "date", "day_idx", "cold_stage", "early_ready", "early_risk", "final_risk", "quality_state", "context_mode",
    "baseline_ready", "risk_score", "risk_pre", "risk_adj", "z_score", "a_score", "z_trim_mean_abs", "z_max_abs",
    "anomaly_flag", "anomaly_score", "partial_flag", "travel_flag", "tz_flag", "bad_history_flag", "stable_hold_flag",
    "drift_flag", "drift_top_feature",
)


def model_output(rows: DataFrame) -> DataFrame:
    """The exported columns: flags and risks, z-scores, group representatives; the date as text."""
    z = [c for c in rows.columns if c.endswith("_z")]
    reps = [c for c in rows.columns if c.startswith("z_") and c.endswith("_rep")]
    return rows.select(*MODEL_COLUMNS, *z, *reps).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
