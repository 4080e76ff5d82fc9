"""Raw event tables and their standard form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import EVENT_CATEGORY, EVENT_COLUMNS, HEARTBEAT_TIME_COLUMNS, TIME_COLUMNS, PipelineConfig

DAY_MS, HOUR_MS = 86_400_000, 3_600_000


def first_existing(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate among the columns."""
    return next((c for c in candidates if c in columns), None)


def optional(df: DataFrame, column: str, kind: str) -> Column:
    """A column by ``try_cast``, or null where the table hasn't got it."""
    return F.col(column).try_cast(kind) if column in df.columns else F.lit(None).cast(kind)


def _millis(timestamp: str) -> Column:
    return F.floor(F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {timestamp})") / 1000)


def _epoch_ms(df: DataFrame, column: str, cfg: PipelineConfig, only: Column | None = None, name: str = "_seconds") -> tuple[DataFrame, Column, Column]:
    """(table, UTC milliseconds, milliseconds that local dates come from).

    Numbers, as such or as text, are seconds or milliseconds by the number of digits of the median of
    their user (of the rows where ``only`` holds); other texts are read as timestamps.
    """
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp") or kind == "date":
        ms = _millis(f"cast(`{column}` as timestamp_ntz)")
        return df, ms, ms
    value, parsed = F.col(f"`{column}`").try_cast("decimal(38,3)").try_cast("long"), None
    if kind == "string":
        parsed = F.when(value.isNull(), _millis(f"try_to_timestamp(`{column}`)::timestamp_ntz"))
    seconds = F.lit(cfg.epoch_unit == "s")
    if cfg.epoch_unit == "auto":
        digits = F.length(value.cast("string"))
        units = df.groupBy("uuid").agg((F.percentile(digits if only is None else F.when(only, digits), 0.5) <= 10).alias(name))
        df, seconds = df.join(units, "uuid", "left"), F.coalesce(name, F.lit(False))
    ms = F.when(seconds, value * 1000).otherwise(value)
    local = value if cfg.second_epochs_as_ms else ms
    return (df, ms, local) if parsed is None else (df, F.coalesce(ms, parsed), F.coalesce(local, parsed))


def _local_date(local: Column) -> Column:
    return F.date_from_unix_date(F.floor(local / DAY_MS).cast("int"))


def standard_events(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Events with UTC milliseconds, local date and hour, upper-case name, category and typed optional columns.

    Rows without a user or a time go.  ``seq`` breaks ties in time; a table
    without it gets an order by content.  Without a time zone column dates are UTC.  Where heartbeats
    take their day from another time column than the other events, ``beat_date`` has it.
    """
    raw = raw.where("uuid is not null")
    name_col, time_col = first_existing(raw.columns, EVENT_COLUMNS), first_existing(raw.columns, TIME_COLUMNS)
    if time_col is None:
        raise ValueError("no time column")
    seq = F.col("seq").cast("long") if "seq" in raw.columns else F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
    raw, ms, local = _epoch_ms(raw, time_col, cfg)
    beat_col, beat_local = first_existing(raw.columns, HEARTBEAT_TIME_COLUMNS), None
    if beat_col != time_col:  # heartbeats have a column of their own for their day
        name_or_type = [F.lower(F.trim(F.col(f"`{c}`").cast("string"))) == "heartbeat" for c in ("type", name_col) if c and c in raw.columns]
        beats = F.coalesce(reduce(Column.__or__, name_or_type, F.lit(False)), F.lit(False))
        raw, _, beat_local = _epoch_ms(raw, beat_col, cfg, beats, "_beat_seconds")
    shift = F.lit(0)
    if "tz_offset_minutes" in raw.columns:
        offset = F.coalesce(F.col("tz_offset_minutes").try_cast("double"), F.lit(cfg.default_tz_minutes)) * 60_000
        shift = offset.cast("long")
        local = local + shift
    else:
        local = ms
    name = F.lit(None).cast("string")
    if name_col:
        name = F.col(name_col).cast("string")
        bare = F.btrim(name, F.lit(" \t\n\x0b\f\r\x85\u2028\u2029")) == name  # nothing that the pattern could match
        name = F.upper(F.when(bare, name).otherwise(F.regexp_replace(name, r"^\s+|\s+$", "")))
    category = F.create_map(*[F.lit(x) for pair in EVENT_CATEGORY.items() for x in pair])
    return (
        raw.select(
            F.col("uuid").cast("string").alias("uuid"),
            seq.alias("seq"),
            ms.alias("ms"),
            _local_date(local).alias("date"),
            *([] if beat_local is None else [_local_date(beat_local + shift).alias("beat_date")]),
            F.pmod(F.floor(local / HOUR_MS), F.lit(24)).cast("int").alias("hour"),
            name.alias("event_std"),
            F.lower(optional(raw, "type", "string")).alias("type_std"),
            optional(raw, "sensor_id", "string").alias("sensor_id"),
            optional(raw, "wifi_ssid", "string").alias("wifi_ssid"),
            optional(raw, "cell_lac", "double").alias("cell_lac"),
            optional(raw, "retry_count", "double").alias("retry_count"),
            optional(raw, "queue_size", "double").alias("queue_size"),
            optional(raw, "tz_offset_minutes", "double").alias("tz_offset"),
            optional(raw, "client_last_event_ts", "double").alias("last_event_ts"),
            optional(raw, first_existing(raw.columns, ("step_count", "value")) or "step_count", "double").alias("steps"),
        )
        .where("ms is not null")
        .withColumn("event_cat", F.get(F.array(category[F.col("event_std")]), F.lit(0)))
    )


def from_activity_log(events: DataFrame, users: int | None = None) -> DataFrame:
    """Raw events from an activity log (event_id, ts, user_id, event_type, value, props with a number ``k``).

    ``users`` folds user ids into so many users, for logs with few events a user.
    """
    parsed = F.get_json_object("props", "$.k").cast("int")  # once a row, in a step of its own
    k, kind = F.col("k"), F.col("event_type")
    name = (
        F.when(kind == "view", "SCREEN_INTERACTIVE")
        .when(kind == "purchase", "SCREEN_NON_INTERACTIVE")
        .when((kind == "click") & (k < 15), "NOTIF_INTERRUPTION")
        .when(kind == "click", "USER_INTERACTION")
        .when(kind == "signup", "KEYGUARD_HIDDEN")
        .when(k < 40, "HEARTBEAT")
        .when(k < 65, "WIFI_SSID")
        .when(k < 90, "CELL_CHANGE")
        .otherwise("STEP_COUNT")
    )
    user = F.pmod("user_id", F.lit(users)) if users else F.col("user_id")
    named = events.withColumn("k", parsed).withColumns({"event_name": name, "user": user})
    beat, wifi, cell = (F.col("event_name") == x for x in ("HEARTBEAT", "WIFI_SSID", "CELL_CHANGE"))
    typed = beat & (F.col("user") % 4 != 0) & (F.col("k") % 5 != 0)  # other heartbeats are known by name alone
    return named.select(
        F.col("user").cast("string").alias("uuid"),
        F.col("event_id").alias("seq"),
        "event_name",
        F.col("ts").alias("timestamp"),
        F.when(typed, "heartbeat").otherwise("system_event").alias("type"),
        F.when(wifi, F.concat(F.lit("ssid-"), F.col("event_id") % 5)).alias("wifi_ssid"),
        F.when(cell, F.col("k").cast("double")).alias("cell_lac"),
        F.when(beat, (F.col("k") % 5).cast("double")).alias("retry_count"),
        F.when(beat, (F.col("k") % 30).cast("double")).alias("queue_size"),
        F.when(F.col("k") == 7, 480).when(F.col("k") != 11, 540).alias("tz_offset_minutes"),
        F.when(F.col("k") < 97, F.col("value")).alias("step_count"),
        F.when(beat, _millis("cast(ts as timestamp_ntz)").cast("double")).alias("client_last_event_ts"),
    )


def from_public_csv(df: DataFrame) -> DataFrame:
    """Renames the columns of public sensor files; the sensor's upper-case name is the event."""
    renamed = df.withColumnsRenamed({"ts_raw": "timestamp", "CellTower_LAC": "cell_lac", "Wifi_SSID": "wifi_ssid", "Acc_Avg": "step_count"})
    return renamed.withColumn("event_name", F.upper("sensor_id"))
