"""SQL for the registered queries: one chain of common table expressions, cut where a query needs it."""

from __future__ import annotations

from pulsegrid.config import BASE_COLUMNS, DELTA_COLUMNS, DRIFT_COLUMNS, EVENT_CATEGORY, RATIO_COLUMNS, STD_FLOOR, Z_COLUMNS, Z_GROUPS

LEAST_EVENTS = 20
#: Logs with fewer events a user are folded into so many users that each has about as many, and into eight at least.
EVENTS_PER_USER, LEAST_USERS = 1250, 8


def each(template: str, names, sep: str = ", ") -> str:
    return sep.join(template.replace("{c}", n) for n in names)


def _case(mapping: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _rolling(c: str, kind: str, partition: str, n: int, least: int) -> str:
    w = f"(PARTITION BY {partition} ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    enough, floor = f"count({c}_w) OVER {w} >= {least}", STD_FLOOR[c]
    return (
        f"CASE WHEN {enough} THEN avg({c}_w) OVER {w} END AS {c}_mean_{kind}, "
        f"greatest(coalesce(CASE WHEN {enough} THEN stddev_pop({c}_w) OVER {w} END, {floor}), {floor}) AS {c}_std_{kind}"
    )


def _clip(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {low}), {high}) END"


def _trim(values: str) -> str:
    v = f"list_sort(list_filter({values}, lambda x: x IS NOT NULL))"
    return f"CASE WHEN len({v}) > 0 THEN list_avg({v}[1:greatest(1, CAST(floor(len({v}) * 0.8) AS INTEGER))]) END"


def _top(prefix: str, names, size: str) -> tuple[str, str]:
    """(name, value) of the first column whose absolute value is ``size``."""
    name = " ".join(f"WHEN abs({c}{prefix}) = {size} THEN '{c}'" for c in names)
    value = " ".join(f"WHEN abs({c}{prefix}) = {size} THEN {c}{prefix}" for c in names)
    return f"CASE {name} END", f"CASE {value} END"


_Z = [f"{c}_z" for c in Z_COLUMNS]
_NAME, _VALUE = _top("_z", Z_COLUMNS, "z_max_abs")
_DRIFT_NAME, _ = _top("_drift", DRIFT_COLUMNS, "drift_size")
_REPS = "[" + ", ".join(f"z_{g}_rep" for g in Z_GROUPS) + "]"
_U = "(PARTITION BY uuid ORDER BY date)"
MOVES = "event_cat IN ('Screen', 'UserAct', 'Unlock')"

def links(base: tuple[str, ...] = BASE_COLUMNS, public: bool = False) -> list[tuple[str, str]]:
    """The chain for a table that has these base columns; ``public``: screens without sessions, and no moves between networks."""
    renamed = "CASE WHEN event_std LIKE 'SCREEN%' THEN 'SCREEN' ELSE event_std END" if public else "event_std"
    only = " WHERE event_std NOT IN ('WIFI_SSID', 'CELL_CHANGE', 'STEP_COUNT')" if public else ""
    return [
        ("folds", f"SELECT greatest({LEAST_USERS}, count(*) // {EVENTS_PER_USER}) AS users FROM events"),
        ("raw", """
SELECT user_id % users AS u, event_id AS seq, epoch_us(ts) // 1000 AS ms, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type
FROM events CROSS JOIN folds WHERE user_id IS NOT NULL AND ts IS NOT NULL"""),
        ("named", """
SELECT *, CASE event_type WHEN 'view' THEN 'SCREEN_INTERACTIVE' WHEN 'purchase' THEN 'SCREEN_NON_INTERACTIVE' WHEN 'signup' THEN 'KEYGUARD_HIDDEN'
    WHEN 'click' THEN CASE WHEN k < 15 THEN 'NOTIF_INTERRUPTION' ELSE 'USER_INTERACTION' END
    ELSE CASE WHEN k < 40 THEN 'HEARTBEAT' WHEN k < 65 THEN 'WIFI_SSID' WHEN k < 90 THEN 'CELL_CHANGE' ELSE 'STEP_COUNT' END END AS event_std,
  CASE WHEN k = 7 THEN 480.0 WHEN k <> 11 THEN 540.0 END AS tz, ms + 60000 * CASE WHEN k = 7 THEN 480 ELSE 540 END AS local FROM raw"""),
        ("ev", f"""
SELECT CAST(u AS VARCHAR) AS uuid, seq, ms, DATE '1970-01-01' + CAST(local // 86400000 AS INTEGER) AS date,
  CAST((local // 3600000) % 24 AS INTEGER) AS hour, {renamed} AS event_std, {_case(EVENT_CATEGORY, "event_std")} AS event_cat, tz,
  event_std = 'HEARTBEAT' AND u % 4 <> 0 AND k % 5 <> 0 AS typed, CASE WHEN event_std = 'STEP_COUNT' AND k < 97 THEN value END AS steps,
  CASE WHEN event_std = 'WIFI_SSID' THEN 'ssid-' || (seq % 5) END AS wifi_ssid,
  CASE WHEN event_std = 'CELL_CHANGE' THEN CAST(k AS DOUBLE) END AS cell_lac,
  CASE WHEN event_std = 'HEARTBEAT' THEN CAST(k % 5 AS DOUBLE) END AS retry_count,
  CASE WHEN event_std = 'HEARTBEAT' THEN CAST(k % 30 AS DOUBLE) END AS queue_size
FROM named{only}"""),
        ("act", """
SELECT uuid, date, count(*) FILTER (event_cat = 'Screen') AS "Screen", count(*) FILTER (event_cat = 'UserAct') AS "UserAct",
  count(*) FILTER (event_cat = 'Notif') AS "Notif", count(*) FILTER (event_cat = 'Unlock') AS "Unlock"
FROM ev WHERE event_cat IS NOT NULL GROUP BY uuid, date"""),
        ("hist", f"SELECT uuid, date, hour, count(*) AS c FROM ev WHERE {MOVES} GROUP BY ALL"),
        ("rhythm0", """
SELECT uuid, date, CAST(sum(c) AS BIGINT) AS n, sum(CASE WHEN hour < 6 THEN c ELSE 0 END) AS night,
  sum(CASE WHEN hour >= 6 AND hour < 18 THEN c ELSE 0 END) AS day, sum(CASE WHEN hour >= 18 THEN c ELSE 0 END) AS eve,
  max(c) AS top, ln(sum(c)) - sum(c * ln(c)) / sum(c) AS ent, arg_min(hour, -c * 100 + hour) AS peak
FROM hist GROUP BY uuid, date"""),
        ("rhythm", f"""
SELECT uuid, date, n AS rhythm_event_cnt, CASE WHEN ok THEN (night + 1) / (n + 24) END AS night_ratio,
  CASE WHEN ok THEN ent END AS hour_entropy, CASE WHEN ok THEN day / n END AS day_ratio, CASE WHEN ok THEN eve / n END AS evening_ratio,
  CASE WHEN ok THEN CAST(peak AS DOUBLE) END AS peak_hour, CASE WHEN ok THEN top / n END AS peak_ratio, NOT ok AS rhythm_low_coverage
FROM (SELECT *, n >= {LEAST_EVENTS} AS ok FROM rhythm0)"""),
        ("steps0", f"SELECT uuid, date, (ms - lag(ms) OVER (PARTITION BY uuid, date ORDER BY ms, seq)) / 3.6e6 AS g FROM ev WHERE {MOVES}"),
        ("gapday", f"SELECT uuid, date, count(*) AS n, min(ms) AS a, max(ms) AS b FROM ev WHERE {MOVES} GROUP BY uuid, date"),
        ("over", f"""
SELECT *, CASE WHEN date - lag(date) OVER {_U} = 1 AND a - lag(b) OVER {_U} >= 0 THEN (a - lag(b) OVER {_U}) / 3.6e6 END AS og FROM gapday"""),
        ("gapstat", """
SELECT uuid, date, max(g) AS mx, quantile_cont(g, 0.95) AS p95, count(*) FILTER (g >= 2) AS c2, count(*) FILTER (g >= 6) AS c6, sum(g) FILTER (g >= 2) AS s2
FROM (SELECT uuid, date, g FROM steps0 WHERE g > 0 UNION ALL SELECT uuid, date, og FROM over WHERE og IS NOT NULL) GROUP BY uuid, date"""),
        ("gap", f"""
SELECT uuid, date, n AS gap_event_cnt, og AS overnight_gap, CAST((a // 3600000) % 24 AS DOUBLE) AS first_hour, CAST((b // 3600000) % 24 AS DOUBLE) AS last_hour,
  n < {LEAST_EVENTS} AS gap_low_coverage, CASE WHEN n >= {LEAST_EVENTS} THEN mx END AS gap_max, CASE WHEN n >= {LEAST_EVENTS} THEN p95 END AS gap_p95,
  CASE WHEN n >= {LEAST_EVENTS} THEN CAST(coalesce(c2, 0) AS DOUBLE) END AS gap_cnt_2h, CASE WHEN n >= {LEAST_EVENTS} THEN CAST(coalesce(c6, 0) AS DOUBLE) END AS gap_cnt_6h,
  CASE WHEN n >= {LEAST_EVENTS} THEN least(coalesce(s2, 0) / 24, 1.0) END AS gap_long_ratio
FROM over LEFT JOIN gapstat USING (uuid, date)"""),
        ("turns", """
SELECT *, coalesce(sum(CASE WHEN event_std = 'SCREEN_NON_INTERACTIVE' THEN 1 ELSE 0 END) OVER (PARTITION BY uuid, date ORDER BY ms, seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS turn
FROM ev WHERE event_std IN ('SCREEN_INTERACTIVE', 'SCREEN_NON_INTERACTIVE')"""),
        ("sessions", """
SELECT uuid, date, turn, (max(ms) FILTER (event_std = 'SCREEN_NON_INTERACTIVE') - min(ms) FILTER (event_std = 'SCREEN_INTERACTIVE')) / 1000.0 AS sec
FROM turns GROUP BY uuid, date, turn"""),
        ("sess", """
SELECT uuid, date, count(*) FILTER (sec > 0 AND sec < 21600) AS session_cnt, coalesce(sum(sec) FILTER (sec > 0 AND sec < 21600), 0.0) AS session_total_sec,
  avg(sec) FILTER (sec > 0 AND sec < 21600) AS session_mean_sec, count(*) FILTER (sec >= 1800 AND sec < 21600) AS long_session_cnt
FROM sessions GROUP BY uuid, date"""),
        ("hops", """
SELECT uuid, date, event_std, cell_lac, coalesce(wifi_ssid, 'None') AS ssid, steps,
  lag(coalesce(wifi_ssid, 'None')) OVER (PARTITION BY uuid, date, event_std ORDER BY ms, seq) AS prev
FROM ev WHERE event_std IN ('WIFI_SSID', 'CELL_CHANGE', 'STEP_COUNT')"""),
        ("mob", """
SELECT uuid, date, count(*) FILTER (event_std = 'CELL_CHANGE') AS cell_change_cnt, count(*) FILTER (event_std = 'WIFI_SSID' AND ssid <> prev) AS wifi_change_cnt_est,
  CAST(count(DISTINCT ssid) FILTER (event_std = 'WIFI_SSID') AS DOUBLE) AS unique_wifi_cnt, CAST(count(DISTINCT cell_lac) FILTER (event_std = 'CELL_CHANGE') AS DOUBLE) AS unique_cell_cnt,
  CASE WHEN count(*) FILTER (event_std = 'STEP_COUNT') > 0 THEN coalesce(sum(steps), 0.0) END AS step_sum
FROM hops GROUP BY uuid, date"""),
        ("beats", "SELECT *, bool_or(typed) OVER (PARTITION BY uuid) AS by_type FROM ev WHERE event_std = 'HEARTBEAT'"),
        ("meta", """
SELECT uuid, date, count(*) AS heartbeat_cnt, max(retry_count) AS retry_max, max(queue_size) AS queue_max, min(tz) AS tz_offset_min, max(tz) AS tz_offset_max,
  coalesce(max(tz) - min(tz) >= 60, false) AS tz_changed, CAST(max(ms) AS DOUBLE) AS qc_last_ts_max
FROM beats WHERE typed OR NOT by_type GROUP BY uuid, date"""),
        ("merged", """
SELECT * FROM act FULL JOIN rhythm USING (uuid, date) FULL JOIN gap USING (uuid, date) FULL JOIN sess USING (uuid, date)
  FULL JOIN mob USING (uuid, date) FULL JOIN meta USING (uuid, date)"""),
        ("qc", f"""
SELECT * REPLACE (coalesce("Screen", 0) AS "Screen", coalesce("UserAct", 0) AS "UserAct", coalesce("Notif", 0) AS "Notif", coalesce("Unlock", 0) AS "Unlock"),
  coalesce("Unlock", 0) AS unlock_cnt, coalesce("Screen", 0) + coalesce("UserAct", 0) AS daily_event_cnt,
  coalesce("Screen", 0) + coalesce("UserAct", 0) > 0 AS has_activity, coalesce("Screen", 0) + coalesce("UserAct", 0) < {LEAST_EVENTS} AS qc_core_low_cov,
  coalesce("Screen", 0) + coalesce("UserAct", 0) BETWEEN 1 AND 9 AS qc_core_very_low_activity, coalesce(rhythm_low_coverage, true) AS qc_rhythm_low_cov,
  coalesce(gap_low_coverage, true) AS qc_gap_low_cov, coalesce(heartbeat_cnt, 0) < 1 AS qc_meta_low_heartbeat,
  coalesce(retry_max >= 3, false) AS qc_meta_retry_warn, coalesce(queue_max >= 20, false) AS qc_meta_queue_warn
FROM merged"""),
        ("ctx", f"""
SELECT *, CAST(tz_changed AS DOUBLE) AS tz_change_signal,
  CASE WHEN qc_core_very_low_activity THEN 1.0::DOUBLE + CAST(qc_meta_retry_warn AS INTEGER) + CAST(qc_meta_queue_warn AS INTEGER) ELSE 0.0 END AS partial_signal_raw,
  CAST(2 * coalesce(CAST(tz_changed AS INTEGER), 0)
    + CASE WHEN cell_change_cnt >= 2 * lag(cell_change_cnt) OVER {_U} + 10 THEN 1 ELSE 0 END
    + CASE WHEN wifi_change_cnt_est >= 2 * lag(wifi_change_cnt_est) OVER {_U} + 10 THEN 1 ELSE 0 END
    + CASE WHEN coalesce(unique_cell_cnt, 0) >= lag(coalesce(unique_cell_cnt, 0)) OVER {_U} + 3 THEN 1 ELSE 0 END AS DOUBLE) AS travel_signal_raw
FROM qc"""),
        ("feat", f"""
SELECT *, {each("CAST({c} AS DOUBLE) - lag(CAST({c} AS DOUBLE)) OVER " + _U + " AS {c}_d1", DELTA_COLUMNS)},
  {each("(CAST({c} AS DOUBLE) - lag(CAST({c} AS DOUBLE)) OVER " + _U + ") / (abs(lag(CAST({c} AS DOUBLE)) OVER " + _U + ") + 1e-6) AS {c}_r1", RATIO_COLUMNS)}
FROM ctx"""),
        ("prep0", f"""
SELECT * REPLACE (coalesce(session_cnt, 0) AS session_cnt, coalesce(step_sum, 0.0) AS step_sum,
    coalesce(gap_max, CASE WHEN daily_event_cnt = 0 THEN 24.0 END) AS gap_max),
  isodow(date) >= 6 AS is_weekend, date - min(date) OVER (PARTITION BY uuid) + 1 AS day_idx,
  qc_core_low_cov OR qc_rhythm_low_cov OR qc_gap_low_cov AS low, partial_signal_raw >= 1 AS partial_flag, coalesce(tz_change_signal, 0) >= 1 AS tz_flag,
  travel_signal_raw >= 2 OR coalesce(tz_change_signal, 0) >= 1 AS travel_flag
FROM feat"""),
        ("prep", """
SELECT *, CASE WHEN day_idx <= 4 THEN 'ONBOARD' WHEN day_idx <= 8 THEN 'WARMUP' WHEN day_idx <= 15 THEN 'SEMI_READY' ELSE 'READY' END AS cold_stage,
  CASE WHEN partial_flag AND travel_flag THEN 'PARTIAL|TRAVEL' WHEN partial_flag THEN 'PARTIAL' WHEN travel_flag THEN 'TRAVEL' ELSE 'NORMAL' END AS context_mode,
  CASE WHEN low THEN 'LOW_CONF' ELSE 'GOOD' END AS quality_state, has_activity AND NOT low AND NOT partial_flag AND NOT travel_flag AS fit
FROM prep0"""),
        ("bounds", "SELECT " + each(
            "count({c}) FILTER (fit) AS {c}_n, quantile_cont(CAST({c} AS DOUBLE), 0.005) FILTER (fit) AS {c}_lo, quantile_cont(CAST({c} AS DOUBLE), 0.995) FILTER (fit) AS {c}_hi", base) + " FROM prep"),
        ("wins", "SELECT prep.*, " + each(
            "CASE WHEN fit THEN CASE WHEN {c}_n >= 10 THEN CASE WHEN {c} IS NOT NULL THEN least(greatest(CAST({c} AS DOUBLE), {c}_lo), {c}_hi) END ELSE CAST({c} AS DOUBLE) END END AS {c}_w", base) + " FROM prep CROSS JOIN bounds"),
        ("roll", "SELECT *, " + ", ".join(
            _rolling(c, kind, part, n, least) for c in base
            for kind, part, n, least in (("lt_g", "uuid", 30, 10), ("st_g", "uuid", 14, 7), ("early_g", "uuid", 7, 3), ("st_own", "uuid, is_weekend", 14, 5), ("early_own", "uuid, is_weekend", 7, 3))) + " FROM wins"),
        ("base0", "SELECT *, " + each(
            "coalesce({c}_mean_st_own, {c}_mean_st_g, {c}_mean_lt_g) AS {c}_mean_st_s, {c}_std_st_own AS {c}_std_st_s, coalesce({c}_mean_early_own, {c}_mean_early_g) AS {c}_mean_early_s, {c}_std_early_own AS {c}_std_early_s", base) + " FROM roll"),
        ("base", "SELECT *, " + each("coalesce({c}_mean_st_s, {c}_mean_early_s) AS {c}_mean_final, {c}_std_st_own AS {c}_std_final", base)
            + ", " + each("{c}_mean_st_s IS NOT NULL", base, " AND ") + " AS baseline_ready, " + each("{c}_mean_early_s IS NOT NULL", base, " AND ") + " AS early_ready FROM base0"),
        ("z", "SELECT *, baseline_ready AND quality_state = 'GOOD' AS scored, " + each(
            "CASE WHEN baseline_ready AND quality_state = 'GOOD' THEN 4 * tanh((CAST({c} AS DOUBLE) - {c}_mean_st_s) / {c}_std_st_s / 4) END AS {c}_z", Z_COLUMNS) + " FROM base"),
        ("anom0", "SELECT *, CASE WHEN scored THEN (" + each("abs(coalesce({c}, 0.0))", _Z, " + ") + f") / {len(_Z)} END AS anomaly_score_raw FROM z"),
        ("quant", "SELECT uuid, quantile_cont(anomaly_score_raw, 0.8) AS ql, quantile_cont(anomaly_score_raw, 0.99) AS qh FROM anom0 GROUP BY uuid"),
        ("anom", """
SELECT anom0.*, CASE WHEN anomaly_score_raw IS NOT NULL THEN CASE WHEN qh > ql THEN least(greatest((anomaly_score_raw - ql) / (qh - ql), 0.0), 1.0) ELSE 0.0 END END AS anomaly_score,
  anomaly_score_raw >= qh AS anomaly_flag
FROM anom0 LEFT JOIN quant USING (uuid)"""),
        ("reps0", "SELECT *, " + ", ".join(
            f"list_aggregate([{each('abs({c}_z)', cols)}], 'quantile_cont', {0.85 if g == 'core' else 0.9}) AS z_{g}_rep" for g, cols in Z_GROUPS.items()) + " FROM anom"),
        ("reps", f"SELECT *, {_trim(_REPS)} AS z_trim_mean_abs, greatest({each('abs({c})', _Z)}) AS z_max_abs FROM reps0"),
        ("risk0", f"""
SELECT *, {_clip("1 - exp(-z_trim_mean_abs / (tau + 1e-6))", "0", "0.999")} AS z_score, {_clip("anomaly_score", "0", "0.999")} AS a_score
FROM reps CROSS JOIN (SELECT greatest(coalesce(quantile_cont(z_trim_mean_abs, 0.9) FILTER (scored), 1.0), 1e-6) AS tau FROM reps)"""),
        ("risk1", f"""
SELECT *, CASE WHEN scored THEN {_clip("0.85 * z_score + 0.15 * a_score", "0", "1")} END AS risk_pre,
  CASE WHEN contains(context_mode, 'PARTIAL') THEN 0.6 WHEN context_mode = 'TRAVEL' THEN 0.7 ELSE 1.0 END AS disc FROM risk0"""),
        ("risk2", f"SELECT *, risk_pre * disc AS risk_adj, count(risk_pre) OVER {_U} AS k FROM risk1"),
        ("risk", f"""
SELECT *, CASE WHEN scored THEN pow(0.75, k) * sum(CASE WHEN k = 1 THEN 1.0 ELSE 0.25 END * risk_adj * pow(0.75, -k)) OVER {_U} END AS risk_score FROM risk2"""),
        ("early0", "SELECT *, quality_state = 'GOOD' AND cold_stage IN ('WARMUP', 'SEMI_READY') AND early_ready AS early_day, " + each(
            "CASE WHEN quality_state = 'GOOD' AND cold_stage IN ('WARMUP', 'SEMI_READY') AND early_ready THEN abs(4 * tanh((CAST({c} AS DOUBLE) - {c}_mean_early_s) / {c}_std_early_s / 4)) END AS {c}_e", base) + " FROM risk"),
        ("mids", "SELECT " + each("coalesce(nullif(quantile_cont({c}_e, 0.5), 0), 1.0) AS {c}_m", base) + " FROM early0"),
        ("early1", f"SELECT early0.*, {_trim('[' + each('{c}_e / {c}_m', base) + ']')} AS z_trim_mean_abs_early FROM early0 CROSS JOIN mids"),
        ("early", f"""
SELECT *, CASE WHEN early_day THEN {_clip("(1 - exp(-z_trim_mean_abs_early / (te + 1e-6))) / (1 - exp(-4.0 / (te + 1e-6)) + 1e-6)", "0", "1")} END AS early_risk
FROM early1 CROSS JOIN (SELECT greatest(coalesce(quantile_cont(z_trim_mean_abs_early, 0.9) FILTER (early_day), 1.0), 1e-6) AS te FROM early1)"""),
        ("final", "SELECT *, coalesce(risk_score, early_risk) AS final_risk FROM early"),
        ("recov", """
SELECT *, coalesce(count(final_risk) OVER w >= 7 AND max(final_risk) OVER w >= 0.7, false) AS bad_history_flag
FROM final WINDOW w AS (PARTITION BY uuid ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"""),
        ("drift0", "SELECT *, bad_history_flag AND coalesce(final_risk < 0.45, false) AS stable_hold_flag, " + ", ".join(
            f"({c}_mean_final - avg(CAST({c} AS DOUBLE)) FILTER (fit AND day_idx BETWEEN 16 AND 30) OVER (PARTITION BY uuid)) / "
            f"CASE WHEN stddev_samp(CAST({c} AS DOUBLE)) FILTER (fit AND day_idx BETWEEN 16 AND 30) OVER (PARTITION BY uuid) IS NOT NULL THEN greatest(stddev_samp(CAST({c} AS DOUBLE)) FILTER (fit AND day_idx BETWEEN 16 AND 30) OVER (PARTITION BY uuid), {STD_FLOOR[c]}) END AS {c}_drift"
            for c in DRIFT_COLUMNS) + " FROM recov"),
        ("drift1", f"SELECT *, greatest({each('abs({c}_drift)', DRIFT_COLUMNS)}) AS drift_size FROM drift0"),
        ("model", f"""
SELECT *, day_idx > 30 AND coalesce(drift_size >= 2, false) AS drift_flag,
  CASE WHEN day_idx > 30 AND coalesce(drift_size >= 2, false) THEN {_DRIFT_NAME} ELSE '' END AS drift_top_feature FROM drift1"""),
        ("dec0", f"""
SELECT *, coalesce(quality_state <> 'LOW_CONF' AND final_risk IS NOT NULL AND (baseline_ready OR early_ready), false) AS ready,
  CASE WHEN final_risk IS NULL THEN 'UNKNOWN' WHEN final_risk < 0.45 THEN 'SAFE' WHEN final_risk < 0.6 THEN 'WATCH' WHEN final_risk < 0.7 THEN 'ALERT' ELSE 'SEVERE' END AS risk_band,
  {_NAME} || '_z' AS top_name, {_VALUE} AS top_value FROM model"""),
        ("dec1", "SELECT *, CASE WHEN ready THEN coalesce(top_name, 'none') ELSE 'none' END AS top_z_feature, CASE WHEN ready THEN coalesce(top_value, 0.0) ELSE 0.0 END AS top_z_value FROM dec0"),
        ("dec2", """
SELECT *, CASE WHEN z_rhythm_rep >= 1.5 THEN z_rhythm_rep END AS s1,
  CASE WHEN z_core_rep >= 1.5 AND top_z_feature IN ('daily_event_cnt_z', 'UserAct_z', 'Screen_z') THEN z_core_rep END AS s2,
  CASE WHEN z_gap_rep >= 1.5 THEN z_gap_rep END AS s3 FROM dec1"""),
        ("dec3", """
SELECT *, CASE WHEN NOT ready THEN 'NO_DATA' WHEN travel_flag THEN 'TRAVEL'
  WHEN greatest(s1, s2, s3) IS NOT NULL THEN CASE WHEN s1 = greatest(s1, s2, s3) THEN 'SLEEP' WHEN s2 = greatest(s1, s2, s3) THEN 'LETHARGY' ELSE 'CHAOS' END
  WHEN abs(top_z_value) < 2 THEN 'STABLE' WHEN top_z_feature IN ('night_ratio_z', 'overnight_gap_z') THEN 'SLEEP'
  WHEN top_z_feature IN ('daily_event_cnt_z', 'UserAct_z', 'Screen_z') THEN CASE WHEN top_z_value < 0 THEN 'LETHARGY' ELSE 'STABLE' END
  WHEN top_z_feature IN ('hour_entropy_z', 'gap_max_z', 'gap_cnt_6h_z') THEN 'CHAOS' ELSE 'STABLE' END AS cat_state FROM dec2"""),
        ("dec4", """
SELECT *, CASE WHEN cat_state IN ('NO_DATA', 'TRAVEL') THEN 'NONE' WHEN cat_state = 'STABLE' THEN CASE WHEN stable_hold_flag OR drift_flag THEN 'LOW' ELSE 'NONE' END
  WHEN partial_flag OR tz_flag OR travel_flag THEN 'NONE' WHEN risk_band = 'ALERT' THEN 'LOW' WHEN risk_band = 'SEVERE' THEN 'HIGH' ELSE 'NONE' END AS level FROM dec3"""),
        ("state", """
SELECT uuid, strftime(date, '%Y-%m-%d') AS date, cat_state,
  CASE WHEN cold_stage IN ('ONBOARD', 'WARMUP') THEN 'NONE' WHEN cold_stage = 'SEMI_READY' AND level = 'HIGH' THEN 'LOW' ELSE level END AS notify_final,
  CASE WHEN cold_stage IN ('ONBOARD', 'WARMUP') THEN 'NONE' WHEN cold_stage = 'SEMI_READY' AND level = 'HIGH' THEN 'LOW' ELSE level END AS notify_level,
  CASE WHEN cat_state <> 'NO_DATA' THEN 'OK' WHEN quality_state = 'LOW_CONF' THEN 'LOW_CONF' ELSE 'NO_DATA' END AS decoder_quality,
  final_risk AS risk_used, risk_score, final_risk, risk_band, top_z_feature, top_z_value FROM dec4"""),
    ]


def forest_links(trees: int, tree_rows: int, seed: int, null_share: float, z: tuple[str, ...] = tuple(_Z)) -> list[tuple[str, str]]:
    """The chain whose anomaly is the isolation forest: rows drawn, trees grown level by level, and every scored row sent down them."""
    unit, prime, levels = 1_000_000_000, 2_147_483_647, max(1, (tree_rows - 1).bit_length())
    factor, shift = f"(1 + (t * 2654435761 + {seed}) % {prime - 1})", f"((t * 2246822519 + {seed}) % {prime})"
    md5 = lambda kind: f"CAST('0x' || substr(md5(concat_ws(':', {seed}, t, node, '{kind}')), 1, 15) AS BIGINT)"
    units = ", ".join(f"CAST(floor(coalesce({c}, 0.0) * {unit} + 0.5) AS BIGINT)" for c in z)
    shares = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in z)
    gamma = repr(0.5772156649015329)
    path = f"CASE WHEN n > 2 THEN 2 * (ln(n - 1) + {gamma}) - 2.0 * (n - 1) / n WHEN n = 2 THEN 1 ELSE 0 END"
    made = [
        ("shares", f"SELECT list_filter(range(1, {len(z) + 1}), lambda i: [{shares}][i] < {null_share}) AS few FROM z"),
        ("used", f"SELECT unnest(CASE WHEN len(few) > 0 THEN few ELSE range(1, {len(z) + 1}) END) AS f FROM shares"),
        ("pool", """SELECT *, CAST('0x' || substr(md5(concat_ws(':', """ + str(seed) + f""", uuid, strftime(date, '%Y-%m-%d'))), 1, 15) AS BIGINT) AS row_, [{units}] AS v
FROM z WHERE CASE WHEN (SELECT bool_or(scored AND fit) FROM z) THEN scored AND fit WHEN (SELECT bool_or(scored) FROM z) THEN scored ELSE true END"""),
        ("drawn", f"""SELECT t, v FROM (SELECT t, v, row_number() OVER (PARTITION BY t ORDER BY (row_ % {prime} * {factor} + {shift}) % {prime}, row_, uuid, date) AS r
FROM pool CROSS JOIN range({trees}) g(t)) WHERE r <= {tree_rows}"""),
        ("deep", "SELECT ceil(log2(greatest(2, max(n)))) AS depth, max(n) AS n FROM (SELECT count(*) AS n FROM drawn GROUP BY t)"),
        ("at0", "SELECT t, 1 AS node, v FROM drawn"),
    ]
    for d in range(levels):
        made += [
            (f"span{d}", f"SELECT t, node, f, min(v[f]) AS lo, max(v[f]) AS hi FROM at{d} CROSS JOIN used GROUP BY t, node, f"),
            (f"split{d}", f"""SELECT t, node, s.f AS f, s.lo + {md5('place')} % (s.hi - s.lo) AS cut
FROM (SELECT t, node, ss[CAST({md5('feature')} % len(ss) AS INTEGER) + 1] AS s FROM (SELECT t, node, list({{'f': f, 'lo': lo, 'hi': hi}} ORDER BY f) AS ss FROM span{d} WHERE hi > lo GROUP BY t, node))
WHERE {d} < (SELECT depth FROM deep)"""),
            (f"at{d + 1}", f"SELECT t, 2 * node + CASE WHEN v[f] <= cut THEN 0 ELSE 1 END AS node, v FROM at{d} JOIN split{d} USING (t, node)"),
        ]
    made += [
        ("inner_", " UNION ALL ".join(f"SELECT * FROM split{d}" for d in range(levels))),
        ("sizes", " UNION ALL ".join(f"SELECT t, node, {d} AS depth, count(*) AS n FROM at{d} GROUP BY t, node" for d in range(levels + 1))),
        ("down0", f"SELECT uuid, date, t, 1 AS node, [{units}] AS v FROM z CROSS JOIN range({trees}) g(t) WHERE scored"),
    ]
    made += [
        (f"down{d + 1}", f"SELECT uuid, date, t, CASE WHEN f IS NULL THEN node ELSE 2 * node + CASE WHEN v[f] <= cut THEN 0 ELSE 1 END END AS node, v FROM down{d} LEFT JOIN inner_ USING (t, node)")
        for d in range(levels)
    ]
    made += [
        ("ends", f"SELECT uuid, date, avg(depth + {path}) AS depth FROM down{levels} JOIN sizes USING (t, node) GROUP BY uuid, date"),
        ("forest", f"SELECT uuid, date, pow(2, -depth / (SELECT greatest({path}, 1e-12) FROM deep)) AS raw FROM ends".replace("depth / ", "ends.depth / ")),
        ("anom0", "SELECT z.*, raw AS anomaly_score_raw FROM z LEFT JOIN forest USING (uuid, date)"),
    ]
    chain = []
    for name, sql in CTES:
        chain += made if name == "anom0" else [(name, sql)]
    return chain


CTES = links()
#: What a table without session and network events has.
PUBLIC_BASE = tuple(c for c in BASE_COLUMNS if c not in ("session_total_sec", "session_cnt", "step_sum"))
PUBLIC = links(PUBLIC_BASE, True)


def upto(name: str, select: str, chain: list[tuple[str, str]] = CTES) -> str:
    """A query over one link of the chain, with the links before it."""
    at = [n for n, _ in chain].index(name)
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in chain[: at + 1]) + "\n" + select
