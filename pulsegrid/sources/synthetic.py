"""Made-up events of users who live normally, send nothing but heartbeats, travel, or crowd their day into the morning.

Every value is a hash of the seed and the event's place, so a table comes out the same
however it is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event names and shares of the hours of a day.
EVENT_NAMES = (
    "SCREEN_INTERACTIVE", "SCREEN_NON_INTERACTIVE", "USER_INTERACTION", "KEYGUARD_HIDDEN",
    "NOTIF_INTERRUPTION", "WIFI_SSID", "CELL_CHANGE",
)
NORMAL_HOURS = (1, 1, 1, 1, 1, 1, 2, 4, 6, 8, 8, 7, 6, 7, 8, 8, 7, 6, 5, 4, 3, 2, 2, 1)
CHAOS_HOURS = (0, 0, 0, 0, 0, 0, 8, 10, 10, 10, 8, 6, 2, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0)
ABROAD_DAYS = (9, 19)
HOME_MINUTES = 540


def _draw(seed: int, what: str, n: int | Column) -> Column:
    """A whole number below n, from the event's place."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "uuid", "day", "i"), F.lit(n) if isinstance(n, int) else n)


def _hour(seed: int, weights: tuple[int, ...]) -> Column:
    ends = [sum(weights[: i + 1]) for i in range(len(weights))]
    drawn = _draw(seed, "hour", ends[-1])
    return F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= drawn))


def synthetic_events(
    spark: SparkSession, first: str, days: int, normal: int = 35, silent: int = 10, travel: int = 5, chaos: int = 0, seed: int = 42
) -> DataFrame:
    """Raw events of the given numbers of users, on ``days`` days from ``first``; ``scenario`` and ``dt`` tell what was made for which day."""
    counts = {"normal": normal, "silent": silent, "travel": travel, "chaos": chaos}
    scenario, upto = F.lit(None).cast("string"), 0
    for name, n in counts.items():
        scenario = F.when((F.col("id") >= upto) & (F.col("id") < upto + n), name).otherwise(scenario)
        upto += n
    users = spark.range(upto).select(F.format_string("user-%06d", "id").alias("uuid"), scenario.alias("scenario"))
    user_days = users.select("*", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day")).withColumn("i", F.lit(-1))
    out, back = ABROAD_DAYS
    abroad = (F.col("scenario") == "travel") & F.col("day").between(out, back)
    user_days = user_days.withColumn("tz", F.when(abroad, 0).otherwise(HOME_MINUTES))

    beats = [(F.lit(True), 30, F.col("tz"))]
    for day, tz in ((out, (HOME_MINUTES, 0)), (back, (0, HOME_MINUTES))):
        on = (F.col("scenario") == "travel") & (F.col("day") == day)
        beats += [(on, 60, F.lit(tz[0])), (on, 12 * 60, F.lit(tz[1]))]
    beat = F.array_compact(F.array(*[F.when(on, F.struct(F.lit(m).alias("minute"), tz.alias("tz"))) for on, m, tz in beats]))
    beats = user_days.withColumn("beat", F.explode(beat)).select(
        "uuid", "scenario", "day", "i", F.col("beat.tz").alias("tz"), (F.col("beat.minute") * 60_000).alias("of_day"), F.lit("HEARTBEAT").alias("event_name"), F.lit("heartbeat").alias("type")
    )

    usual = F.when(F.col("scenario") == "silent", 0).otherwise(130 + _draw(seed, "count", 41))
    usual = user_days.withColumn("usual", usual).where("usual > 0")
    usual = usual.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("usual") - 1))).drop("usual")
    hour = F.when(F.col("scenario") == "chaos", _hour(seed, CHAOS_HOURS)).when(F.col("scenario") == "travel", 6 + _draw(seed, "hour", 18)).otherwise(_hour(seed, NORMAL_HOURS))
    of_day = (hour * 3600 + _draw(seed, "second", 3600)) * 1000
    name = F.get(F.array(*[F.lit(n) for n in EVENT_NAMES]), _draw(seed, "name", len(EVENT_NAMES)).cast("int"))
    usual = usual.select("uuid", "scenario", "day", "i", "tz", of_day.alias("of_day"), name.alias("event_name"), F.lit("system_event").alias("type"))

    extra = user_days.where(abroad).withColumn("i", F.explode(F.sequence(F.lit(1000), F.lit(1039))))
    extra = extra.withColumn("of_day", ((6 + _draw(seed, "hour", 17)) * 3600 + _draw(seed, "second", 3600)) * 1000)
    pair = F.array(F.struct(F.lit("WIFI_SSID").alias("n"), F.lit(0).alias("ms")), F.struct(F.lit("CELL_CHANGE").alias("n"), F.lit(500).alias("ms")))
    extra = extra.withColumn("pair", F.explode(pair)).select(
        "uuid", "scenario", "day", "i", "tz", (F.col("of_day") + F.col("pair.ms")).alias("of_day"), F.col("pair.n").alias("event_name"), F.lit("system_event").alias("type")
    )

    rows = beats.unionByName(usual).unionByName(extra)
    day = F.date_add(F.lit(first).cast("date"), F.col("day"))
    ms = F.unix_date(day).cast("long") * 86_400_000 - HOME_MINUTES * 60_000 + F.col("of_day")
    wifi, cell, away = F.col("event_name") == "WIFI_SSID", F.col("event_name") == "CELL_CHANGE", F.col("tz") == 0
    beat = F.col("type") == "heartbeat"
    ssid = F.when(away, F.concat(F.lit("ssid-abroad-"), _draw(seed, "ssid", 50))).otherwise(F.concat(F.lit("ssid-"), _draw(seed, "ssid", 5)))
    return rows.select(
        "uuid",
        "event_name",
        ms.alias("timestamp"),
        "type",
        F.when(wifi, ssid).alias("wifi_ssid"),
        F.when(wifi, F.concat(F.lit("bssid-"), _draw(seed, "bssid", 50))).alias("prev_wifi_bssid"),
        F.when(wifi, "wifi_disconnected").alias("wifi_change_type"),
        F.when(beat, 0).otherwise(_draw(seed, "steps", 201)).cast("int").alias("step_count"),
        F.when(cell | away & ~beat, (10_000 + _draw(seed, "cell", 90_000)).cast("double")).alias("cell_lac"),
        F.when(beat, 0.0).otherwise(_draw(seed, "queue", 6).cast("double")).alias("queue_size"),
        F.when(beat, 0.0).otherwise(_draw(seed, "retry", 2).cast("double")).alias("retry_count"),
        F.col("tz").alias("tz_offset_minutes"),
        ms.alias("client_last_event_ts"),
        "scenario",
        day.alias("dt"),
    )
