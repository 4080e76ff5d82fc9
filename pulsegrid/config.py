"""All thresholds and window sizes of the event pipeline in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

# Event names, column candidates and constants that results depend on.
EVENT_CATEGORY = {
    "USER_INTERACTION": "UserAct",
    "SCREEN_INTERACTIVE": "Screen",
    "SCREEN_NON_INTERACTIVE": "Screen",
    "NOTIF_INTERRUPTION": "Notif",
    "KEYGUARD_HIDDEN": "Unlock",
    "SCREEN": "Screen",
    "USERACT": "UserAct",
    "NOTIF": "Notif",
    "UNLOCK": "Unlock",
}
EVENT_COLUMNS = ("event_name", "sensor_id", "event", "name", "action", "type_name", "eventCode", "event_id", "event_type")
TIME_COLUMNS = ("ts_raw", "timestamp", "ts", "time", "event_time", "created_at", "occurred_at", "client_ts", "client_time")
HEARTBEAT_TIME_COLUMNS = ("timestamp", "ts_raw", "ts", "client_ts", "client_time", "time", "event_time", "created_at", "occurred_at")
STEP_NAMES = ("Step_Count", "Step", "Steps", "STEP_COUNT", "STEP", "Acc_Avg")
RHYTHM_CATEGORIES = ("Screen", "UserAct", "Unlock")
SESSION_START, SESSION_END = "SCREEN_INTERACTIVE", "SCREEN_NON_INTERACTIVE"
STD_FLOOR = {
    "daily_event_cnt": 10.0,
    "night_ratio": 0.05,
    "hour_entropy": 0.05,
    "Notif": 5.0,
    "UserAct": 5.0,
    "Screen": 3.0,
    "gap_max": 0.5,
    "gap_cnt_2h": 1.0,
    "gap_long_ratio": 0.05,
    "overnight_gap": 0.5,
    "gap_p95": 0.5,
    "gap_cnt_6h": 0.5,
    "session_total_sec": 60.0,
    "session_cnt": 1.0,
    "step_sum": 50.0,
}
BASE_COLUMNS = (
    "Screen", "Notif", "UserAct", "daily_event_cnt", "night_ratio", "hour_entropy", "gap_max",
    "gap_cnt_2h", "gap_long_ratio", "gap_p95", "gap_cnt_6h", "session_total_sec", "session_cnt", "step_sum",
)
Z_COLUMNS = (
    "daily_event_cnt", "Screen", "Notif", "UserAct", "night_ratio", "hour_entropy",
    "gap_max", "gap_p95", "gap_cnt_2h", "gap_cnt_6h", "gap_long_ratio",
)
Z_GROUPS = {
    "core": ("Screen", "Notif", "UserAct", "daily_event_cnt"),
    "rhythm": ("night_ratio", "hour_entropy"),
    "gap": ("gap_max", "gap_p95", "gap_cnt_2h", "gap_cnt_6h", "gap_long_ratio"),
}
DELTA_COLUMNS = (
    "daily_event_cnt", "night_ratio", "hour_entropy", "gap_max", "gap_p95", "gap_cnt_2h", "gap_cnt_6h",
    "session_total_sec", "session_cnt", "step_sum", "cell_change_cnt", "wifi_change_cnt_est",
    "travel_signal_raw", "partial_signal_raw", "tz_change_signal",
)
RATIO_COLUMNS = ("daily_event_cnt", "session_total_sec", "step_sum")
DRIFT_COLUMNS = ("daily_event_cnt", "night_ratio", "gap_max")
SLEEP_FEATURES = ("night_ratio_z", "overnight_gap_z")
LETHARGY_FEATURES = ("daily_event_cnt_z", "UserAct_z", "Screen_z")
CHAOS_FEATURES = ("hour_entropy_z", "gap_max_z", "gap_cnt_6h_z")


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of features, baselines, risk and decoding."""

    epoch_unit: str = "auto"  # "auto" looks at the median number of digits of each user; or "s", "ms"
    second_epochs_as_ms: bool = True  # local dates of second epochs as the deployed pipeline has them
    default_tz_minutes: int = 540
    min_daily_events: int = 50
    min_rhythm_events: int = 50
    min_gap_events: int = 50
    min_heartbeats: int = 1
    retry_warn: float = 3
    queue_warn: float = 20
    tz_change_minutes: float = 60
    very_low_events: int = 10
    gap_hours: float = 2.0
    long_gap_hours: float = 6.0
    gap_quantile: float = 0.95
    segment_events: int = 1_000_000  # a user's day of more events is worked on in segments of about as many
    segment_slot_ms: int = 1000  # which are cut between such slots
    segment_rows: int | None = None  # daily rows of a user that one task windows over; None: all (as many as days)
    session_limit_sec: int = 6 * 3600
    long_session_sec: int = 30 * 60
    base_columns: tuple[str, ...] = BASE_COLUMNS
    default_floor: float = 0.1
    winsor: tuple[float, float] = (0.005, 0.995)
    winsor_least: int = 10
    lt_window: int = 30
    lt_least: int = 10
    st_window: int = 14
    st_least: int = 7
    st_split_least: int = 5
    early_window: int = 7
    early_least: int = 3
    z_clip: float = 4.0
    core_quantile: float = 0.85
    other_quantile: float = 0.90
    weight_z: float = 0.85
    weight_a: float = 0.15
    discount: dict[str, float] = field(default_factory=lambda: {"PARTIAL": 0.60, "TRAVEL": 0.70})
    ema_alpha: float = 0.25
    hold_window: int = 14
    hold_least: int = 7
    bad_risk: float = 0.70
    stable_risk: float = 0.45
    anchor_days: tuple[int, int] = (16, 30)
    drift_z: float = 2.0
    scale_quantiles: tuple[float, float] = (0.80, 0.99)
    partial_level: float = 1.0
    travel_level: float = 2.0
    tz_level: float = 1.0
    risk_bands: tuple[float, float, float] = (0.45, 0.60, 0.70)
    z_top: float = 2.0
    z_group: float = 1.5
    trees: int = 300
    tree_rows: int = 256
    seed: int = 42
    feature_null_share: float = 0.60

    def floor(self, column: str) -> float:
        return STD_FLOOR.get(column, self.default_floor)
