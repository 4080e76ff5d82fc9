"""Daily states and notification levels from the model's output: expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import CHAOS_FEATURES, LETHARGY_FEATURES, SLEEP_FEATURES, PipelineConfig
from pulsegrid.functions.columns import top_by_abs

STATE_COLUMNS = (
    "uuid", "date", "cat_state", "notify_final", "notify_level", "decoder_quality", "risk_used", "risk_score",
    "final_risk", "risk_band", "top_z_feature", "top_z_value",
)
DEFAULTS = {"baseline_ready": False, "early_ready": False, "partial_flag": False, "tz_flag": False, "travel_flag": False, "stable_hold_flag": False, "drift_flag": False}


def risk_band(risk: Column, cfg: PipelineConfig) -> Column:
    low, alert, severe = cfg.risk_bands
    return F.when(risk.isNull(), "UNKNOWN").when(risk < low, "SAFE").when(risk < alert, "WATCH").when(risk < severe, "ALERT").otherwise("SEVERE")


def pattern_state(name: Column, value: Column, rhythm: Column, core: Column, gap: Column, cfg: PipelineConfig) -> Column:
    """The group with the largest representative from the threshold on (sleep, lethargy, chaos; the first among equals), else the top feature."""
    t = cfg.z_group
    lethargic = name.isin(*LETHARGY_FEATURES)
    sleep, leth, chaos = F.when(rhythm >= t, rhythm), F.when((core >= t) & lethargic, core), F.when(gap >= t, gap)
    best = F.greatest(sleep, leth, chaos)
    by_top = (
        F.when(F.abs(value) < cfg.z_top, "STABLE")
        .when(name.isin(*SLEEP_FEATURES), "SLEEP")
        .when(lethargic, F.when(value < 0, "LETHARGY").otherwise("STABLE"))
        .when(name.isin(*CHAOS_FEATURES), "CHAOS")
        .otherwise("STABLE")
    )
    return F.when(best.isNull(), by_top).when(sleep == best, "SLEEP").when(leth == best, "LETHARGY").otherwise("CHAOS")


def decode(model: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """One state row for each model row."""
    for c, v in DEFAULTS.items():
        model = model.withColumn(c, F.coalesce(c, F.lit(v)) if c in model.columns else F.lit(v))
    for c in ("final_risk", "risk_score", "z_rhythm_rep", "z_core_rep", "z_gap_rep"):
        if c not in model.columns:
            model = model.withColumn(c, F.lit(None).cast("double"))
    z = [c for c in model.columns if c.endswith("_z")]
    used = F.coalesce("final_risk", "risk_score")
    quality = F.coalesce("quality_state", F.lit(""))
    rows = model.select("*", used.alias("risk_used"), risk_band(used, cfg).alias("risk_band"), top_by_abs([(c, F.col(c)) for c in z]).alias("_top"))
    rows = rows.withColumn("ready", (quality != "LOW_CONF") & F.col("risk_used").isNotNull() & (F.col("baseline_ready") | F.col("early_ready")))
    rows = rows.withColumns(
        {
            "top_z_feature": F.when(F.col("ready"), F.coalesce("_top.name", F.lit("none"))).otherwise("none"),
            "top_z_value": F.when(F.col("ready"), F.coalesce("_top.value", F.lit(0.0))).otherwise(F.lit(0.0)),
        }
    )
    pattern = pattern_state(F.col("top_z_feature"), F.col("top_z_value"), F.col("z_rhythm_rep"), F.col("z_core_rep"), F.col("z_gap_rep"), cfg)
    state = F.when(~F.col("ready"), "NO_DATA").when(F.col("travel_flag"), "TRAVEL").otherwise(pattern)
    rows = rows.withColumn("cat_state", state)
    base = F.when(F.col("risk_band") == "ALERT", "LOW").when(F.col("risk_band") == "SEVERE", "HIGH").otherwise("NONE")
    in_context = F.when(F.col("travel_flag") | F.col("partial_flag") | F.col("tz_flag"), "NONE").otherwise(base)
    level = (
        F.when(F.col("cat_state").isin("NO_DATA", "TRAVEL"), "NONE")
        .when(F.col("cat_state") == "STABLE", F.when(F.col("stable_hold_flag") | F.col("drift_flag"), "LOW").otherwise("NONE"))
        .otherwise(in_context)
    )
    stage = F.upper(F.coalesce("cold_stage", F.lit("")))
    final = F.when(stage.isin("ONBOARD", "WARMUP"), "NONE").when((stage == "SEMI_READY") & (level == "HIGH"), "LOW").otherwise(level)
    confidence = F.when(F.col("cat_state") != "NO_DATA", "OK").when(quality == "LOW_CONF", "LOW_CONF").otherwise("NO_DATA")
    return rows.withColumns({"notify_final": final, "notify_level": final, "decoder_quality": confidence}).select(*STATE_COLUMNS)
