"""Queries of the event engine and the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import BASE_COLUMNS, DELTA_COLUMNS, RATIO_COLUMNS, Z_COLUMNS, Z_GROUPS, PipelineConfig
from pulsegrid.functions.columns import rounded
from pulsegrid.operators import anomaly, baseline, decoder, features, reports, risk
from pulsegrid.plans.oracles import CTES, EVENTS_PER_USER, LEAST_EVENTS, LEAST_USERS, PUBLIC, forest_links, upto
from pulsegrid.sources import days
from pulsegrid.sources.events import from_activity_log, standard_events
from pulsegrid.sources.tables import settle, shared_folder

CFG = PipelineConfig(epoch_unit="ms", min_daily_events=LEAST_EVENTS, min_rhythm_events=LEAST_EVENTS, min_gap_events=LEAST_EVENTS)
KEYS = ("uuid", "date")


#: The same with days, and users' days, worked on in segments of seven rows.
SEGMENTED = replace(CFG, segment_events=7, segment_slot_ms=1, segment_rows=7)


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """What the event files are: names, sizes and times of change."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(path) or []
    return tuple(sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found))


_kept: dict[tuple, object] = {}


def forget() -> None:
    """Queries from now on share nothing with those before."""
    _kept.clear()


def _shared(make: Callable) -> Callable:
    """Queries of one session share what ``make`` gives, as long as the event files are the same.

    Tables of files that have changed since are forgotten.
    """

    def get(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = CFG):
        place = (make.__name__, id(spark), sf_dir, cfg is SEGMENTED)
        version = _version(spark, sf_dir)
        if place not in _kept or _kept[place][0] != version:
            _kept[place] = (version, make(spark, sf_dir, cfg))
        return _kept[place][1]

    return get


def _events(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = CFG, public: bool = False) -> DataFrame:
    """Standard events; ``public`` ones have no sessions and no networks, as public files have them."""
    log = spark.read.parquet(f"{sf_dir}/events.parquet")
    users = max(LEAST_USERS, log.count() // EVENTS_PER_USER)  # from the files' footers
    raw = from_activity_log(log, users)
    if public:
        raw = raw.where(~F.col("event_name").isin("WIFI_SSID", "CELL_CHANGE", "STEP_COUNT"))
        raw = raw.withColumn("event_name", F.when(F.col("event_name").startswith("SCREEN"), "SCREEN").otherwise(F.col("event_name")))
    return standard_events(raw, cfg)


@_shared
def _features(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return settle(features.daily_features(_events(spark, sf_dir, cfg), cfg), "features")


@_shared
def _public_features(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return settle(features.daily_features(_events(spark, sf_dir, cfg, public=True), cfg), "public-features")


@_shared
def _scored(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return settle(baseline.baselines(_features(spark, sf_dir, cfg), cfg), "baselines")


@_shared
def _scaled(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return anomaly.scale_by_user(anomaly.mean_abs_z(_scored(spark, sf_dir, cfg)), cfg)


@_shared
def _risk(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return settle(risk.risk_table(_scaled(spark, sf_dir, cfg), cfg), "risk")


@_shared
def _states(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    return settle(decoder.decode(risk.model_output(_risk(spark, sf_dir, cfg)), cfg), "states")


@_shared
def _forest(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> DataFrame:
    rows = risk.risk_inputs(_scored(spark, sf_dir, cfg), cfg)  # no risk takes the other baselines
    return settle(anomaly.scale_by_user(anomaly.forest_scores(rows, anomaly.train_forest(rows, cfg), cfg), cfg), "forest")


@_shared
def _day_tables(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> str:
    """A folder with the daily features by day."""
    root = f"{shared_folder(spark)}/pulsegrid-days-{uuid.uuid4().hex}"
    _features(spark, sf_dir, cfg).withColumn("dt", F.col("date")).write.partitionBy("dt").parquet(f"{root}/daily")
    return root


def _baseline_of_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    root = f"{_day_tables(spark, sf_dir)}/baseline"
    days.write_baseline(_scored(spark, sf_dir), root, day)
    return days.read_day(spark, root, day)


def _states_of_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    root = f"{_day_tables(spark, sf_dir)}/states"
    days.write_state(_states(spark, sf_dir).select(*KEYS, "cat_state", "notify_level"), root, day)
    return spark.read.schema("uuid string, date string, cat_state string, notify_level int").csv(days.current(spark, days.day_folder(root, day)), header=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


#: Columns that aren't doubles and so aren't rounded in SQL.
EXACT = {
    "uuid", "date", "seq", "ms", "hour", "event_std", "event_cat", "wifi_ssid", *features.BLOCKS["activity"], "rhythm_event_cnt",
    "rhythm_low_coverage", "gap_event_cnt", "gap_low_coverage", "session_cnt", "long_session_cnt", "cell_change_cnt", "wifi_change_cnt_est",
    "heartbeat_cnt", "tz_changed", "daily_event_cnt", "unlock_cnt", "is_weekend", "day_idx", "scored", "baseline_ready", "early_ready",
    "cold_stage", "context_mode", "quality_state", "drift_top_feature", "cat_state", "notify_final", "notify_level", "decoder_quality",
    "risk_band", "top_z_feature", "has_activity",
}


def _exact(c: str) -> bool:
    return c in EXACT or c.startswith("qc_") and c != "qc_last_ts_max" or c.endswith(("_flag", "_n"))


def _register(name: str, make: Callable[[SparkSession, str], DataFrame], link: str | None = None, columns=(), sql: str | None = None, doubles=(), chain=CTES) -> None:
    """A query; its SQL selects the columns of one link of the chain, or is given with the columns to round."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = make(spark, sf_dir)
        return rounded(df.select(*columns) if columns else df)

    run.__name__ = name
    QUERIES[name] = run
    if link:
        sql = sql or "SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM {link}"
        rounds = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in (doubles or [c for c in columns if not _exact(c)]))
        ORACLE_SQL[name] = upto(link, f"SELECT * REPLACE ({rounds}) FROM ({sql})" if rounds else sql, chain)


_block_links = {"activity": "act", "rhythm": "rhythm", "gap": "gap", "session": "sess", "mobility": "mob", "meta": "meta"}
_block_names = {"meta": "daily_meta_qc"}
QC = ("daily_event_cnt", "unlock_cnt", "has_activity", "qc_core_low_cov", "qc_core_very_low_activity", "qc_rhythm_low_cov", "qc_gap_low_cov",
      "qc_meta_low_heartbeat", "qc_meta_retry_warn", "qc_meta_queue_warn")
MERGED = tuple(c for b in features.BLOCKS for c in features.BLOCKS[b])
Z = tuple(f"{c}_z" for c in Z_COLUMNS)
REPS = tuple(f"z_{g}_rep" for g in Z_GROUPS)

_register("events_std", _events, "ev", ("uuid", "seq", "ms", "date", "hour", "event_std", "event_cat", "wifi_ssid", "cell_lac", "retry_count", "queue_size"))
for _b, _link in _block_links.items():
    _register(
        _block_names.get(_b, f"daily_{_b}"),
        lambda s, d, b=_b: features.block(features.daily_blocks(_events(s, d), CFG), b),
        _link,
        (*KEYS, *features.BLOCKS[_b]),
    )
_register("feature_merge", lambda s, d: features.daily_blocks(_events(s, d), CFG), "merged", (*KEYS, *MERGED))
_register("qc_flags", _features, "qc", (*KEYS, *QC))
_register("context_signals", _features, "ctx", (*KEYS, "tz_change_signal", "partial_signal_raw", "travel_signal_raw"))
_register("delta_features", _features, "feat", (*KEYS, *[f"{c}_d1" for c in DELTA_COLUMNS], *[f"{c}_r1" for c in RATIO_COLUMNS]))
_register("model_context", lambda s, d: baseline.prepare(_features(s, d), CFG), "prep", (*KEYS, "is_weekend", "day_idx", "partial_flag", "tz_flag", "travel_flag", "cold_stage", "context_mode", "quality_state"))
_register(
    "winsor_bounds",
    lambda s, d: baseline.winsor_bounds(baseline.prepare(_features(s, d), CFG), CFG).select(
        *[x for c in BASE_COLUMNS for x in (F.col(f"{c}_n"), F.col(f"{c}_q")[0].alias(f"{c}_lo"), F.col(f"{c}_q")[1].alias(f"{c}_hi"))]
    ),
    "bounds",
    tuple(f"{c}_{x}" for c in BASE_COLUMNS for x in ("n", "lo", "hi")),
)
for _name, _kind in (("baseline_lt", "lt_g"), ("baseline_st_global", "st_g"), ("baseline_st_split", "st_s"), ("baseline_early", "early_s"), ("baseline_final", "final")):
    _register(_name, _scored, "base", (*KEYS, *[f"{c}_{x}_{_kind}" for c in BASE_COLUMNS for x in ("mean", "std")], "baseline_ready", "early_ready"))
_register("zscores", _scored, "z", (*KEYS, "scored", *Z))
_register("anomaly_scaling", _scaled, "anom", (*KEYS, "anomaly_score_raw", "anomaly_score", "anomaly_flag"))
_register("z_group_reps", _risk, "reps", (*KEYS, *REPS, "z_trim_mean_abs", "z_max_abs"))
_register("risk_pre", _risk, "risk", (*KEYS, "z_score", "a_score", "risk_pre", "risk_adj"))
_register("risk_ema", _risk, "risk", (*KEYS, "risk_adj", "risk_score"))
_register("early_risk", _risk, "early", (*KEYS, "z_trim_mean_abs_early", "early_risk"))
_register("final_risk", _risk, "final", (*KEYS, "risk_score", "early_risk", "final_risk"))
_register("bad_history", _risk, "drift0", (*KEYS, "bad_history_flag", "stable_hold_flag"))
_register("segmented_features", lambda s, d: _features(s, d, SEGMENTED), "feat", (*KEYS, *MERGED, *QC, *[f"{c}_d1" for c in DELTA_COLUMNS], *[f"{c}_r1" for c in RATIO_COLUMNS]))
_register("segmented_baselines", lambda s, d: _scored(s, d, SEGMENTED), "z", (*KEYS, *[f"{c}_{x}_{k}" for c in BASE_COLUMNS for x in ("mean", "std") for k in ("lt_g", "st_s", "early_s")], "baseline_ready", "scored", *Z))
_register("segmented_model_out", lambda s, d: _risk(s, d, SEGMENTED), "model", (*risk.MODEL_COLUMNS, *Z, *REPS))
_register("drift", _risk, "model", (*KEYS, "daily_event_cnt_drift", "night_ratio_drift", "gap_max_drift", "drift_flag", "drift_top_feature"))
_register("model_out", _risk, "model", (*risk.MODEL_COLUMNS, *Z, *REPS))
_register("state_out_surrogate", _states, "state", decoder.STATE_COLUMNS)
FOREST = forest_links(CFG.trees, CFG.tree_rows, CFG.seed, CFG.feature_null_share)
_register("isolation_forest_scores", _forest, "anom", (*KEYS, "anomaly_score_raw", "anomaly_score", "anomaly_flag"), chain=FOREST)
_register("state_out", lambda s, d: decoder.decode(risk.model_output(risk.risk_table(_forest(s, d), CFG)), CFG), "state", decoder.STATE_COLUMNS, chain=FOREST)

_register("state_distribution", lambda s, d: reports.distribution(_states(s, d), "cat_state"), "state",
          doubles=("share",),
          sql="SELECT cat_state, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM state GROUP BY cat_state")
_register("transition_matrix", lambda s, d: reports.transition_matrix(_states(s, d)), "state",
          sql="SELECT coalesce(prev, 'ALL') AS prev, coalesce(cur, 'ALL') AS cur, count(*) AS n FROM (SELECT lag(cat_state) OVER (PARTITION BY uuid ORDER BY date) AS prev, cat_state AS cur FROM state) WHERE prev IS NOT NULL GROUP BY CUBE (prev, cur)")
ALARMS = "(SELECT *, risk_score >= (SELECT quantile_cont(risk_score, 0.99) FROM model) AS alarm FROM model WHERE risk_score IS NOT NULL)"
_register("risk_thresholds", lambda s, d: reports.risk_thresholds(_risk(s, d)), "model",
          doubles=("top", "severe"),
          sql="SELECT quantile_cont(risk_score, 0.99) AS top, quantile_cont(risk_score, 0.998) AS severe FROM model")
_register("alarm_runs", lambda s, d: reports.alarm_runs(_risk(s, d)), "model",
          sql=f"SELECT uuid, min(date) AS first_date, count(*) AS days FROM (SELECT uuid, date, alarm, row_number() OVER (PARTITION BY uuid ORDER BY date) - row_number() OVER (PARTITION BY uuid, alarm ORDER BY date) AS island FROM {ALARMS}) WHERE alarm GROUP BY uuid, island")
_register("top_transitions", lambda s, d: reports.top_transitions(_states(s, d)), "state",
          sql="SELECT prev, cur, count(*) AS n FROM (SELECT lag(cat_state) OVER (PARTITION BY uuid ORDER BY date) AS prev, cat_state AS cur FROM state) WHERE prev IS NOT NULL GROUP BY prev, cur ORDER BY n DESC, prev, cur LIMIT 10")
_register("top_z_by_state", lambda s, d: reports.top_z_by_state(_states(s, d)), "state",
          sql="SELECT cat_state, top_z_feature, count(*) AS n FROM state WHERE decoder_quality = 'OK' AND cat_state IN ('SLEEP', 'LETHARGY', 'CHAOS', 'STABLE') GROUP BY cat_state, top_z_feature QUALIFY row_number() OVER (PARTITION BY cat_state ORDER BY count(*) DESC, top_z_feature) <= 5")
_register("user_mode_state", lambda s, d: reports.user_mode_state(_states(s, d)), "state",
          sql="SELECT uuid, cat_state AS mode_state FROM (SELECT uuid, cat_state, row_number() OVER (PARTITION BY uuid ORDER BY count(*) DESC, cat_state) AS r FROM state GROUP BY uuid, cat_state) WHERE r = 1")
_register("alarm_rates", lambda s, d: reports.alarm_rates(_risk(s, d)), "model",
          doubles=("alarm_rate",),
          sql=f"SELECT uuid, avg(CASE WHEN alarm THEN 1.0 ELSE 0.0 END) AS alarm_rate FROM {ALARMS} GROUP BY uuid")
_register("risk_component_corr", lambda s, d: reports.component_correlation(_risk(s, d)), "model",
          doubles=("corr",),
          sql=" UNION ALL ".join(f"SELECT '{c}' AS component, count(*) AS pairs, CASE WHEN count(*) > 30 THEN corr(risk_score, {c}) END AS corr FROM model WHERE risk_score IS NOT NULL AND {c} IS NOT NULL HAVING count(*) > 0" for c in ("z_score", "a_score")))
_register("top200_risk", lambda s, d: reports.top_risk(_risk(s, d).select(*KEYS, "risk_score", "cold_stage")), "model",
          doubles=("risk_score",),
          sql="SELECT uuid, date, risk_score, cold_stage FROM model WHERE risk_score IS NOT NULL ORDER BY risk_score DESC, uuid, date LIMIT 200")
_register("top_z_frequency", lambda s, d: reports.top_z_frequency(_risk(s, d), list(Z)), "model",
          sql="SELECT feature, count(*) AS n FROM (SELECT uuid, date, feature, row_number() OVER (PARTITION BY uuid, date ORDER BY size DESC, i) AS r FROM ("
          + " UNION ALL ".join(f"SELECT uuid, date, '{c}' AS feature, {i} AS i, abs({c}) / (SELECT coalesce(nullif(quantile_cont(abs({c}), 0.5), 0), 1.0) FROM model WHERE quality_state = 'GOOD' AND baseline_ready) AS size FROM (SELECT * FROM model WHERE risk_score IS NOT NULL ORDER BY risk_score DESC, uuid, date LIMIT 200)" for i, c in enumerate(Z))
          + ") WHERE size IS NOT NULL) WHERE r = 1 GROUP BY feature ORDER BY n DESC, feature LIMIT 15")
_register("risk_describe", lambda s, d: reports.describe(_risk(s, d), "risk_score"), "model",
          doubles=("mean", "std", "low", "p50", "p75", "p90", "p95", "p99", "high"),
          sql="SELECT count(risk_score) AS n, avg(risk_score) AS mean, stddev_samp(risk_score) AS std, min(risk_score) AS low, quantile_cont(risk_score, 0.5) AS p50, quantile_cont(risk_score, 0.75) AS p75, quantile_cont(risk_score, 0.9) AS p90, quantile_cont(risk_score, 0.95) AS p95, quantile_cont(risk_score, 0.99) AS p99, max(risk_score) AS high FROM model")
_register("last_events", lambda s, d: reports.keep_last(_events(s, d).select(*KEYS, "seq", "event_std"), "seq"), "ev",
          sql="SELECT uuid, date, max(seq) AS seq, arg_max(event_std, seq) AS event_std FROM ev GROUP BY uuid, date")
_register("duplicate_keys", lambda s, d: reports.duplicate_keys(_events(s, d)), "ev",
          sql="SELECT uuid, date, count(*) AS n FROM ev GROUP BY uuid, date HAVING count(*) > 1")
_register("range_checks", lambda s, d: reports.range_checks(_features(s, d)), "feat",
          sql="SELECT rule, violations FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) FILTER ({v}) AS violations FROM feat" for k, v in reports.CHECKS.items()) + ")")
_register("missing_rates", lambda s, d: reports.missing_rates(_features(s, d), list(MERGED)), "feat",
          doubles=("missing_rate",),
          sql="SELECT feature, missing_rate FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM feat" for c in MERGED) + ") ORDER BY missing_rate DESC, feature LIMIT 20")
_register("day_scan", lambda s, d: days.read_day(s, f"{_day_tables(s, d)}/daily", "2024-01-10").select(*KEYS, "daily_event_cnt"), "feat",
          sql="SELECT uuid, date, daily_event_cnt FROM feat WHERE date = DATE '2024-01-10'")
_register("partition_lookback", lambda s, d: days.read_lookback(s, f"{_day_tables(s, d)}/daily", "2024-01-12", 8).select(*KEYS, "daily_event_cnt"), "feat",
          sql="SELECT uuid, date, daily_event_cnt FROM feat WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
_register("training_range", lambda s, d: days.read_training(s, f"{_day_tables(s, d)}/daily", "2024-01-20", 5).select(*KEYS, "daily_event_cnt"), "feat",
          sql="SELECT uuid, date, daily_event_cnt FROM feat WHERE date BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'")
_register("baseline_sink", lambda s, d: _baseline_of_day(s, d, "2024-01-20"), "base",
          (*KEYS, "baseline_ready", "early_ready", *[f"{c}_{x}_final" for c in BASE_COLUMNS for x in ("mean", "std")]),
          sql="SELECT uuid, date, baseline_ready, early_ready, " + ", ".join(f'"{c}_{x}_final"' for c in BASE_COLUMNS for x in ("mean", "std")) + " FROM base WHERE date = DATE '2024-01-20'")
_register("state_sink", lambda s, d: _states_of_day(s, d, "2024-01-20"), "state", (*KEYS, "cat_state"),
          sql="SELECT uuid, date, cat_state FROM state WHERE CAST(date AS DATE) = DATE '2024-01-20'")
_register("mean_by_readiness", lambda s, d: reports.mean_by_flag(_scored(s, d), "baseline_ready", "daily_event_cnt"), "base",
          doubles=("mean",),
          sql="SELECT baseline_ready, count(*) AS n, avg(daily_event_cnt) AS mean FROM base GROUP BY baseline_ready")
_register("zscores_public", lambda s, d: baseline.baselines(_public_features(s, d), CFG), "z", (*KEYS, "baseline_ready", "early_ready", "scored", *Z), chain=PUBLIC)
_register("union_train",
          lambda s, d: _features(s, d).select(*KEYS, "daily_event_cnt", "step_sum").unionByName(_public_features(s, d).select("night_ratio", *KEYS, "daily_event_cnt"), allowMissingColumns=True), "feat",
          doubles=("step_sum", "night_ratio"),
          sql="SELECT uuid, date, daily_event_cnt, step_sum, NULL::DOUBLE AS night_ratio FROM feat UNION ALL SELECT uuid, date, daily_event_cnt, NULL, night_ratio FROM ("
          + upto("feat", "SELECT * FROM feat", PUBLIC) + ")")
_register("events_by_prefix", lambda s, d: reports.by_prefix(_events(s, d), ("SCREEN", "CELL")).select(*KEYS, "seq", "event_std"), "ev",
          sql="SELECT uuid, date, seq, event_std FROM ev WHERE event_std LIKE 'SCREEN%' OR event_std LIKE 'CELL%'")


def _value_counts(link: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'null') AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM {link} GROUP BY {c}" for c in columns)


def _describe(link: str, columns: tuple[str, ...]) -> str:
    quantiles = ", ".join(f"quantile_cont({{c}}, {q}) AS {n}" for n, q in reports.QUANTILES.items())
    one = f"SELECT '{{c}}' AS feature, count({{c}}) AS n, avg({{c}}) AS mean, stddev_samp({{c}}) AS std, min({{c}}) AS low, {quantiles}, max({{c}}) AS high FROM {link}"
    return " UNION ALL ".join(one.replace("{c}", c) for c in columns)


FACTS = ("mean", "std", "low", *reports.QUANTILES, "high")
GATES = ("cold_stage", "quality_state", "context_mode", "baseline_ready", "early_ready")
DELTAS = (*[f"{c}_d1" for c in DELTA_COLUMNS], *[f"{c}_r1" for c in RATIO_COLUMNS])
MEANS = tuple(f"{c}_{x}_final" for c in BASE_COLUMNS for x in ("mean", "std"))
FLAGS = tuple(c for c in QC if c.startswith("qc_"))
_register("state_distributions", lambda s, d: reports.distributions(_states(s, d), ("notify_level", "decoder_quality")).union(
              reports.distributions(_states(s, d).where("decoder_quality = 'OK'"), ("risk_band",))), "state", doubles=("share",),
          sql=_value_counts("state", ("notify_level", "decoder_quality")) + " UNION ALL " + _value_counts("(SELECT * FROM state WHERE decoder_quality = 'OK')", ("risk_band",)))
_register("gate_distributions", lambda s, d: reports.distributions(_risk(s, d), GATES), "model", doubles=("share",), sql=_value_counts("model", GATES))
_register("mode_state_distribution", lambda s, d: reports.distributions(reports.user_mode_state(_states(s, d)), ("mode_state",)), "state", doubles=("share",),
          sql=_value_counts("(SELECT cat_state AS mode_state FROM (SELECT uuid, cat_state, row_number() OVER (PARTITION BY uuid ORDER BY count(*) DESC, cat_state) AS r FROM state GROUP BY uuid, cat_state) WHERE r = 1)", ("mode_state",)))
_register("notify_coverage", lambda s, d: reports.notify_coverage(_states(s, d)), "state", doubles=("share",),
          sql="SELECT count(*) FILTER (told) AS told, count(*) AS users, avg(CASE WHEN told THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT uuid, bool_or(notify_level <> 'NONE') AS told FROM state GROUP BY uuid)")
_register("component_describe", lambda s, d: reports.describe_columns(_risk(s, d), ("risk_score", "z_score", "a_score")), "model", doubles=FACTS,
          sql=_describe("model", ("risk_score", "z_score", "a_score")))
_register("core_describe", lambda s, d: reports.describe_columns(_features(s, d), ("Screen", "UserAct", "daily_event_cnt", "step_sum")), "feat", doubles=FACTS,
          sql=_describe("feat", ("Screen", "UserAct", "daily_event_cnt", "step_sum")))
_register("baseline_describe", lambda s, d: reports.describe_columns(_scored(s, d), MEANS), "base", doubles=FACTS, sql=_describe("base", MEANS))
_register("baseline_nulls", lambda s, d: reports.null_counts(_scored(s, d), MEANS), "base",
          sql="SELECT feature, nulls FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls FROM base" for c in MEANS) + ") ORDER BY nulls DESC, feature LIMIT 20")
_register("alarm_rate_describe", lambda s, d: reports.describe(reports.alarm_rates(_risk(s, d)), "alarm_rate"), "model", doubles=FACTS,
          sql="SELECT * EXCLUDE (feature) FROM (" + _describe(f"(SELECT uuid, avg(CASE WHEN alarm THEN 1.0 ELSE 0.0 END) AS alarm_rate FROM {ALARMS} GROUP BY uuid)", ("alarm_rate",)) + ")")
_register("alarm_run_describe", lambda s, d: reports.describe(reports.alarm_runs(_risk(s, d)), "days"), "model", doubles=FACTS,
          sql="SELECT * EXCLUDE (feature) FROM (" + _describe(f"(SELECT count(*) AS days FROM (SELECT uuid, date, alarm, row_number() OVER (PARTITION BY uuid ORDER BY date) - row_number() OVER (PARTITION BY uuid, alarm ORDER BY date) AS island FROM {ALARMS}) WHERE alarm GROUP BY uuid, island)", ("days",)) + ")")
_register("qc_rates", lambda s, d: reports.flag_rates(_features(s, d), FLAGS), "feat", doubles=("rate",),
          sql=" UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CASE WHEN {c} THEN 1.0 WHEN NOT {c} THEN 0.0 END) AS rate FROM feat" for c in FLAGS))
_register("delta_missing", lambda s, d: reports.missing_rates(_features(s, d), list(DELTAS)), "feat", doubles=("missing_rate",),
          sql="SELECT feature, missing_rate FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM feat" for c in DELTAS) + ") ORDER BY missing_rate DESC, feature LIMIT 20")
_SUSPECT = ("daily_event_cnt", "heartbeat_cnt", "partial_signal_raw", "travel_signal_raw", "gap_max", "gap_cnt_6h", "night_ratio", "hour_entropy")
_register("suspect_days", lambda s, d: reports.suspect_days(_features(s, d)), "feat", doubles=_SUSPECT[2:],
          sql=f"SELECT uuid, date, {', '.join(_SUSPECT)} FROM feat WHERE daily_event_cnt = 0 AND coalesce(heartbeat_cnt, 0) > 0 OR coalesce(partial_signal_raw, 0) > 0 ORDER BY uuid, date LIMIT 10")


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of a day and the baselines of the day before, by user; both tables are dealt by user where they lie."""
    states = _states(spark, sf_dir).where("date = '2024-01-20'")
    base = _scored(spark, sf_dir).where("date = DATE '2024-01-19'").select(*KEYS, "baseline_ready", "early_ready", "cold_stage")
    return reports.cross_check(reports.bucketed(states, ["uuid"]), reports.bucketed(base, ["uuid"]))


_CHECKED = "(SELECT s.uuid, s.date, cat_state, risk_used, b.date AS date_b, b.baseline_ready, b.early_ready, b.cold_stage FROM (SELECT * FROM state WHERE date = '2024-01-20') s LEFT JOIN (SELECT * FROM base WHERE date = DATE '2024-01-19') b ON s.uuid = b.uuid)"
_register("cross_check", lambda s, d: _checked(s, d).select(*KEYS, "cat_state", "risk_used", "date_b", "baseline_ready", "early_ready", "cold_stage"), "state", doubles=("risk_used",), sql=f"SELECT * FROM {_CHECKED}")
_register("risk_by_readiness", lambda s, d: reports.mean_by_flag(_checked(s, d), "baseline_ready", "risk_used"), "state", doubles=("mean",),
          sql=f"SELECT baseline_ready, count(*) AS n, avg(risk_used) AS mean FROM {_CHECKED} GROUP BY baseline_ready")
