"""Daily features of each user: one shuffle of the events, then windows over the few daily rows.

All blocks of a (user, day) come from the same exchange: window columns (gap to the
event before, open session, network change) and the aggregation to a partial state
share its partitioning.  A day of very many events is cut into segments, each with a state of
its own; states of one day are put together in the order of their times, whether they come from
segments or from batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.config import DELTA_COLUMNS, RATIO_COLUMNS, RHYTHM_CATEGORIES, SESSION_END, SESSION_START, STEP_NAMES, PipelineConfig
from pulsegrid.functions.columns import entropy, row_quantile
from pulsegrid.functions.quantiles import grouped_quantiles
from pulsegrid.operators.segments import cut_days, of_key, windowed
from pulsegrid.sources.tables import settle

BLOCKS = {
    "activity": ("Screen", "UserAct", "Notif", "Unlock"),
    "rhythm": ("rhythm_event_cnt", "night_ratio", "hour_entropy", "day_ratio", "evening_ratio", "peak_hour", "peak_ratio", "rhythm_low_coverage"),
    "gap": ("gap_event_cnt", "overnight_gap", "first_hour", "last_hour", "gap_low_coverage", "gap_max", "gap_p95", "gap_cnt_2h", "gap_cnt_6h", "gap_long_ratio"),
    "session": ("session_cnt", "session_total_sec", "session_mean_sec", "long_session_cnt"),
    "mobility": ("cell_change_cnt", "wifi_change_cnt_est", "unique_wifi_cnt", "unique_cell_cnt", "step_sum"),
    "meta": ("heartbeat_cnt", "retry_max", "queue_max", "tz_offset_min", "tz_offset_max", "tz_changed", "qc_last_ts_max"),
}


def _count(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _facts(events: DataFrame, keys: list[str]) -> DataFrame:
    """What states are made of, in place of names, categories and types: narrow rows, as each is shuffled, sorted and copied by windows."""
    event, beat, category = F.col("as_event"), F.col("as_beat"), F.col("event_cat")
    name = F.coalesce("event_std", F.lit(""))
    cell, wifi = name == "CELL_CHANGE", name == "WIFI_SSID"
    kind = F.coalesce(*[F.when(category == c, i) for i, c in enumerate(BLOCKS["activity"])])
    return events.select(
        *keys, "ms", "seq", "hour", "as_event",
        F.when(event, kind).alias("kind"),
        F.coalesce(category.isin(*RHYTHM_CATEGORIES), F.lit(False)).alias("moves"),
        (name == SESSION_START).alias("starts"),
        (name == SESSION_END).alias("ends"),
        (event & cell).alias("is_cell"),
        (event & wifi).alias("is_wifi"),
        F.when(wifi, F.coalesce("wifi_ssid", F.lit("None"))).alias("ssid"),
        F.when(event & cell, F.col("cell_lac")).alias("lac"),
        (event & (name.isin(*STEP_NAMES) | F.coalesce(F.col("sensor_id").isin(*STEP_NAMES), F.lit(False)))).alias("walks"),
        "steps",
        (F.coalesce(F.col("type_std") == "heartbeat", F.lit(False)) & beat).alias("beat_type"),
        ((F.lower(name) == "heartbeat") & beat).alias("beat_name"),
        "retry_count", "queue_size", "tz_offset", "last_event_ts",
    )


def _event_windows(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the gap to the previous activity event, network changes and session turns, all within a segment and in one order."""
    before = Window.partitionBy(*keys).orderBy("ms", "seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = facts.select(
        "*",
        F.last(F.when(F.col("moves"), F.col("ms")), ignorenulls=True).over(before).alias("prev_ms"),
        F.last("ssid", ignorenulls=True).over(before).alias("prev_ssid"),
        F.coalesce(_count(F.col("ends")).over(before), F.lit(0)).alias("turn"),
        F.coalesce(F.last(F.when(F.col("starts") | F.col("ends"), F.col("starts")), ignorenulls=True).over(before), F.lit(False)).alias("is_open"),
    )
    opened = F.last(F.when(F.col("starts") & ~F.col("is_open"), F.col("ms")), ignorenulls=True).over(before)  # the first start of the turn
    return rows.withColumn("session_sec", F.when(F.col("ends") & (F.col("turn") > 0) & F.col("is_open"), (F.col("ms") - opened) / 1000.0))


#: Heartbeat columns of a state, each kept by type and by name.
_BEATS = ("hb", "retry", "queue", "tz_min", "tz_max", "last")


def _gap_sums(gap: Column, cfg: PipelineConfig) -> list[Column]:
    return [
        F.max(gap).alias("gap_max"),
        _count(gap >= cfg.gap_hours).alias("n_long_gaps"),
        _count(gap >= cfg.long_gap_hours).alias("n_very_long_gaps"),
        F.sum(F.when(gap >= cfg.gap_hours, gap)).alias("long_gaps"),
    ]


def _session_sums(sec: Column, cfg: PipelineConfig) -> list[Column]:
    valid = (sec > 0) & (sec < cfg.session_limit_sec)
    return [
        _count(valid).alias("n_sessions"),
        F.sum(F.when(valid, sec)).alias("session_total"),
        _count(valid & (sec >= cfg.long_session_sec)).alias("n_long"),
    ]


def _with_own_beat_dates(events: DataFrame) -> DataFrame:
    """``as_event`` and ``as_beat``: what a row counts for; a heartbeat dated apart is there twice."""
    both = {"as_event": F.lit(True), "as_beat": F.lit(True)}
    if "beat_date" not in events.columns:
        return events.withColumns(both)
    beats = (F.col("type_std") == "heartbeat") | (F.lower("event_std") == "heartbeat")
    apart = F.coalesce(beats, F.lit(False)) & ~F.col("beat_date").eqNullSafe(F.col("date"))
    kinds = [F.struct(d.alias("date"), F.lit(e).alias("as_event"), F.lit(b).alias("as_beat")) for d, e, b in ((F.col("date"), True, True), (F.col("date"), True, False), (F.col("beat_date"), False, True))]
    rest = [c for c in events.columns if c not in ("date", "beat_date")]
    return events.select(*rest, F.inline(F.when(apart, F.array(*kinds[1:])).otherwise(F.array(kinds[0])))).where("date is not null")


def day_states(events: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> tuple[DataFrame, bool]:
    """Partial states of each (uuid, date), and whether a day may have several.

    A state tells of a run of a user's events on a day, from ``from_ms`` to ``to_ms``:
    counts, first and last activity and the gaps between, first and last network, sessions closed inside,
    the session end that closes one begun before (``head_ms``, opened inside at ``head_start`` if at all) and the
    session left open (``tail_start``).  States of one day whose times don't overlap are put together by
    :func:`merged_days`, so they may be kept, one a batch, and merged later.  Lists in a state
    have at most as many values as it has events.
    """
    rows, cut = cut_days(_with_own_beat_dates(events), cfg.segment_events, cfg.segment_slot_ms)
    keys = ["uuid", "date", "seg"] if cut else ["uuid", "date"]
    rows = _event_windows(_facts(rows, keys), keys)
    event, starts, ends = F.col("as_event"), F.col("starts"), F.col("ends")
    moves, is_cell, is_wifi = F.col("moves") & event, F.col("is_cell"), F.col("is_wifi")
    gap = F.when(moves & (F.col("ms") > F.col("prev_ms")), (F.col("ms") - F.col("prev_ms")) / 3.6e6)
    at = F.when(is_wifi, F.struct("ms", "seq"))
    beats = [
        x
        for kind in ("type", "name")
        for x in (
            _count(F.col(f"beat_{kind}")).alias(f"hb_{kind}"),
            F.max(F.when(F.col(f"beat_{kind}"), F.col("retry_count"))).alias(f"retry_{kind}"),
            F.max(F.when(F.col(f"beat_{kind}"), F.col("queue_size"))).alias(f"queue_{kind}"),
            F.min(F.when(F.col(f"beat_{kind}"), F.col("tz_offset"))).alias(f"tz_min_{kind}"),
            F.max(F.when(F.col(f"beat_{kind}"), F.col("tz_offset"))).alias(f"tz_max_{kind}"),
            F.max(F.when(F.col(f"beat_{kind}"), F.col("last_event_ts"))).alias(f"last_{kind}"),
        )
    ]
    turns = F.coalesce(_count(ends), F.lit(0))
    last_start = F.min(F.when(event & starts, F.struct((-F.col("turn")).alias("turn"), "ms")))  # the first of the last turn that has any
    states = rows.groupBy(*keys).agg(
        F.min("ms").alias("from_ms"),
        F.max("ms").alias("to_ms"),
        *[_count(F.col("kind") == i).alias(c) for i, c in enumerate(BLOCKS["activity"])],
        F.array(*[_count(moves & (F.col("hour") == h)) for h in range(24)]).alias("hours"),
        _count(moves).alias("n_moves"),
        F.min(F.when(moves, F.col("ms"))).alias("first_ms"),
        F.max(F.when(moves, F.col("ms"))).alias("last_ms"),
        F.collect_list(gap).alias("gaps"),
        *_gap_sums(gap, cfg),
        _count(event & (starts | ends)).alias("n_session_events"),
        *_session_sums(F.when(event, F.col("session_sec")), cfg),
        F.when(turns > 0, F.min(F.when(event & starts & (F.col("turn") == 0), F.col("ms")))).alias("head_start"),
        F.min(F.when(event & ends & (F.col("turn") == 0), F.col("ms"))).alias("head_ms"),
        F.when(last_start["turn"] == -turns, last_start["ms"]).alias("tail_start"),
        _count(is_cell | is_wifi).alias("n_mobile"),
        _count(is_cell).alias("n_cell"),
        _count(is_wifi & (F.col("ssid") != F.col("prev_ssid"))).alias("n_wifi_changes"),
        F.min_by("ssid", at).alias("first_ssid"),
        F.max_by("ssid", at).alias("last_ssid"),
        F.collect_set(F.when(is_wifi, F.col("ssid"))).alias("ssids"),
        F.collect_set("lac").alias("lacs"),
        _count(F.col("walks")).alias("n_steps"),
        F.sum(F.when(F.col("walks"), F.col("steps"))).alias("steps"),
        *beats,
    )
    return states.drop("seg"), cut


_SUMS = (
    *BLOCKS["activity"], "n_moves", "n_session_events", "n_sessions", "session_total", "n_long", "n_mobile", "n_cell", "n_wifi_changes",
    "n_steps", "steps", "n_long_gaps", "n_very_long_gaps", "long_gaps", "hb_type", "hb_name",
)
_LEAST = ("first_ms", "tz_min_type", "tz_min_name")
_MOST = ("last_ms", "gap_max", "retry_type", "retry_name", "queue_type", "queue_name", "tz_max_type", "tz_max_name", "last_type", "last_name")


def _carried(states: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """What each state makes of the ones before it: the gap and network change between them, and the session that its first end closes."""
    order = Window.partitionBy("uuid", "date").orderBy("from_ms")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    closes = F.col("head_ms").isNotNull()
    rows = states.select(
        "*",
        F.last("last_ms", ignorenulls=True).over(before).alias("prev_last_ms"),
        F.last("last_ssid", ignorenulls=True).over(before).alias("prev_last_ssid"),
        F.coalesce(_count(closes).over(before), F.lit(0)).alias("closed_before"),
        F.coalesce(_count(closes).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("closed"),
    )
    # sessions left open since the last state with an end, this one's start aside
    left_open = F.min("tail_start").over(Window.partitionBy("uuid", "date", "closed").orderBy("from_ms").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("left_open", left_open)
    rows = rows.withColumn("open_before", F.lag("left_open").over(order))
    between = (F.col("first_ms") - F.col("prev_last_ms")) / 3.6e6
    return rows.select(
        "*",
        F.when(between > 0, between).alias("cross_gap"),
        ((F.col("head_ms") - F.least("open_before", "head_start")) / 1000.0).alias("head_sec"),
        F.coalesce((F.col("first_ssid") != F.col("prev_last_ssid")).cast("long"), F.lit(0)).alias("cross_ssid"),
    )


def _distinct_in_day(states: DataFrame, column: str, name: str) -> DataFrame:
    """(uuid, date, name): different values over all states of a day, counted after each is there once."""
    values = states.select("uuid", "date", F.explode(column).alias("v")).distinct()
    return values.groupBy("uuid", "date").agg(F.count("*").alias(name))


def merged_days(states: DataFrame, several: bool, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """One row a (uuid, date) of all its states, in the order of their times.

    ``several`` says whether a day may have more than one; then the states are read more than once, so they should be a table. Lists of a lone state
    are taken as they are; of several, different values and quantiles are counted over rows, not lists.
    """
    rows = _carried(states, cfg)
    alone = F.count("*") == 1

    def plus(total: Column, more: Column) -> Column:
        return F.when(total.isNull() & more.isNull(), None).otherwise(F.coalesce(total, F.lit(0)) + F.coalesce(more, F.lit(0)))

    cross, head = _gap_sums(F.col("cross_gap"), cfg), _session_sums(F.col("head_sec"), cfg)
    extra = dict(zip(("n_long_gaps", "n_very_long_gaps", "long_gaps"), cross[1:])) | dict(zip(("n_sessions", "session_total", "n_long"), head))
    extra["n_wifi_changes"] = F.sum("cross_ssid")
    days = rows.groupBy("uuid", "date").agg(
        *[(plus(F.sum(c), extra[c]) if c in extra else F.sum(c)).alias(c) for c in _SUMS],
        *[F.min(c).alias(c) for c in _LEAST],
        *[(F.greatest(F.max(c), F.max("cross_gap")) if c == "gap_max" else F.max(c)).alias(c) for c in _MOST],
        F.array(*[F.sum(F.get("hours", F.lit(h))) for h in range(24)]).alias("hours"),
        F.when(alone, F.max("gaps")).alias("gaps"),
        F.when(alone, F.max(F.size("ssids"))).alias("n_ssid"),
        F.when(alone, F.max(F.size("lacs"))).alias("n_lac"),
    )
    if not several:
        return days
    days = settle(days, "days")
    shared = states.join(days.where("gaps is null").select("uuid", "date"), ["uuid", "date"], "left_semi")
    for column, name in (("ssids", "n_ssid"), ("lacs", "n_lac")):
        counted = _distinct_in_day(shared, column, "_n")
        days = days.join(counted, ["uuid", "date"], "left").withColumn(name, F.coalesce(name, "_n", F.lit(0))).drop("_n")
    return days


def _gap_quantiles(states: DataFrame, days: DataFrame, cfg: PipelineConfig, q: float) -> DataFrame:
    """(uuid, date, q) of the gaps of days that have several states."""
    shared = days.where("gaps is null").select("uuid", "date", "overnight")
    inner = states.join(shared.drop("overnight"), ["uuid", "date"], "left_semi")
    between = _carried(inner, cfg).select("uuid", "date", F.col("cross_gap").alias("gap"))
    gaps = inner.select("uuid", "date", F.explode("gaps").alias("gap")).union(between).union(shared)
    return grouped_quantiles(gaps, ["uuid", "date"], F.col("gap"), [q]).select("uuid", "date", F.get("q", F.lit(0)).alias("gap_q"))


def daily_blocks(events: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(uuid, date), the columns of all blocks, and ``has_<block>`` for each; null where a block has no row."""
    return blocks_of_states(*day_states(events, cfg), cfg)


def blocks_of_states(states: DataFrame, several: bool, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """:func:`daily_blocks` from partial states."""
    if several:
        states = settle(states, "states")
    return _finish(merged_days(states, several, cfg), states if several else None, cfg)


def _finish(day: DataFrame, states: DataFrame | None, cfg: PipelineConfig) -> DataFrame:
    """``states``: those of the days, where a day may have several."""
    size = cfg.segment_rows
    if size is not None or states is not None:
        day = settle(day, "merged")
    day = of_key(day, ["uuid"], {"typed": F.max("hb_type")}, size)

    def overnight(rows: DataFrame, part: list[str]) -> DataFrame:
        user = Window.partitionBy(*part).orderBy("date")
        gap = (F.col("first_ms") - F.lag("last_ms").over(user)) / 3.6e6
        adjacent = F.datediff("date", F.lag("date").over(user)) == 1
        return rows.withColumn("overnight", F.when(adjacent & (gap >= 0), gap))

    day = windowed(day, ["uuid"], "date", 1, overnight, size)
    day = day.withColumns({c: F.when(F.col("typed") > 0, F.col(f"{c}_type")).otherwise(F.col(f"{c}_name")) for c in _BEATS})
    over = F.col("overnight")
    day = day.withColumn("gap_q", row_quantile(F.when(over.isNotNull(), F.array_append("gaps", over)).otherwise(F.col("gaps")), cfg.gap_quantile))
    if states is not None:
        of_several = _gap_quantiles(states, day, cfg, cfg.gap_quantile).withColumnRenamed("gap_q", "_q")
        day = day.join(of_several, ["uuid", "date"], "left").withColumn("gap_q", F.coalesce("gap_q", "_q")).drop("_q")
    n = F.col("n_moves")
    flags = {
        "activity": sum((F.col(c) for c in BLOCKS["activity"]), F.lit(0)) > 0,
        "rhythm": n > 0,
        "gap": n > 0,
        "session": F.col("n_session_events") > 0,
        "mobility": (F.col("n_mobile") > 0) | (F.col("n_steps") > 0),
        "meta": F.col("hb") > 0,
    }
    hours, covered = F.col("hours"), n >= cfg.min_rhythm_events

    def span(a: int, b: int) -> Column:
        return F.aggregate(F.slice(hours, a + 1, b - a), F.lit(0).cast("long"), lambda t, x: t + x)

    enough = n >= cfg.min_gap_events

    def with_night(total: str, least: float, one: Column) -> Column:
        return F.coalesce(F.col(total), F.lit(0)) + F.when(over >= least, one).otherwise(F.lit(0))

    tz_moved = F.abs(F.col("tz_max") - F.col("tz_min")) >= cfg.tz_change_minutes
    values = {
        "activity": [F.col(c) for c in BLOCKS["activity"]],
        "rhythm": [
            n,
            F.when(covered, (span(0, 6) + 1) / (n + 24)),
            F.when(covered, entropy(hours, n)),
            F.when(covered, span(6, 18) / n),
            F.when(covered, span(18, 24) / n),
            F.when(covered, (F.array_position(hours, F.array_max(hours)) - 1).cast("double")),
            F.when(covered, F.array_max(hours) / n),
            ~covered,
        ],
        "gap": [
            n,
            F.col("overnight"),
            F.pmod(F.floor(F.col("first_ms") / 3_600_000), F.lit(24)).cast("double"),
            F.pmod(F.floor(F.col("last_ms") / 3_600_000), F.lit(24)).cast("double"),
            ~enough,
            F.when(enough, F.greatest("gap_max", over)),
            F.when(enough, F.col("gap_q")),
            F.when(enough, with_night("n_long_gaps", cfg.gap_hours, F.lit(1)).cast("double")),
            F.when(enough, with_night("n_very_long_gaps", cfg.long_gap_hours, F.lit(1)).cast("double")),
            F.when(enough, F.least(with_night("long_gaps", cfg.gap_hours, over) / 24.0, F.lit(1.0))),
        ],
        "session": [F.col("n_sessions"), F.coalesce("session_total", F.lit(0.0)), F.try_divide("session_total", "n_sessions"), F.col("n_long")],
        "mobility": [
            F.col("n_cell"),
            F.col("n_wifi_changes"),
            F.col("n_ssid").cast("double"),
            F.col("n_lac").cast("double"),
            F.when(F.col("n_steps") > 0, F.coalesce("steps", F.lit(0.0))),
        ],
        "meta": [F.col("hb"), F.col("retry"), F.col("queue"), F.col("tz_min"), F.col("tz_max"), F.coalesce(tz_moved, F.lit(False)), F.col("last")],
    }
    out = day.select(
        "uuid",
        "date",
        *[flag.alias(f"has_{b}") for b, flag in flags.items()],
        *[F.when(flags[b], v).alias(c) for b, cols in BLOCKS.items() for c, v in zip(cols, values[b], strict=True)],
    )
    return out.where(" or ".join(f"has_{b}" for b in BLOCKS))


def block(daily: DataFrame, name: str) -> DataFrame:
    """The rows and columns of one block."""
    return daily.where(f"has_{name}").select("uuid", "date", *BLOCKS[name])


def add_quality_flags(daily: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Zero-filled counts, activity totals and quality flags.

    Takes a table from :func:`with_presence`: without any meta block in it the
    flags of that block are null, as opposed to false.
    """
    filled = daily.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in BLOCKS["activity"] else F.col(c) for c in daily.columns])
    filled = filled.withColumns({"unlock_cnt": F.col("Unlock"), "daily_event_cnt": F.col("Screen") + F.col("UserAct")})
    total = F.col("daily_event_cnt")

    def known(x: Column) -> Column:
        return F.when(F.col("meta_known"), x)

    return filled.withColumns(
        {
            "has_activity": total > 0,
            "qc_core_low_cov": total < cfg.min_daily_events,
            "qc_core_very_low_activity": (total > 0) & (total < cfg.very_low_events),
            "qc_rhythm_low_cov": F.coalesce("rhythm_low_coverage", F.lit(True)),
            "qc_gap_low_cov": F.coalesce("gap_low_coverage", F.lit(True)),
            "qc_meta_low_heartbeat": known(F.coalesce("heartbeat_cnt", F.lit(0)) < cfg.min_heartbeats),
            "qc_meta_retry_warn": known(F.coalesce(F.col("retry_max") >= cfg.retry_warn, F.lit(False))),
            "qc_meta_queue_warn": known(F.coalesce(F.col("queue_max") >= cfg.queue_warn, F.lit(False))),
        }
    )


def with_presence(daily: DataFrame) -> DataFrame:
    """Whether the table has any meta block at all, from a one-row aggregate."""
    daily = settle(daily, "daily")  # read twice
    return daily.crossJoin(F.broadcast(daily.agg(F.coalesce(F.max("has_meta"), F.lit(False)).alias("meta_known"))))


def context_signals(rows: DataFrame, part: list[str]) -> DataFrame:
    """Time zone, partial collection and travel signals; the row before is the user's previous one, of any date."""

    def flag(x: Column) -> Column:
        return F.coalesce(x.cast("int"), F.lit(0)).cast("double")

    user = Window.partitionBy(*part).orderBy("date")

    def surge(c: str) -> Column:
        return flag(F.col(c) >= F.lag(c).over(user) * 2 + 10)

    cells = F.coalesce("unique_cell_cnt", F.lit(0.0))
    tz = F.when(F.col("meta_known"), F.col("tz_changed").cast("double")).otherwise(F.lit(0.0))
    partial = 1.0 + flag(F.col("qc_meta_retry_warn")) + flag(F.col("qc_meta_queue_warn"))
    travel = 2 * F.coalesce(tz, F.lit(0.0)) + surge("cell_change_cnt") + surge("wifi_change_cnt_est") + flag(cells >= F.lag(cells).over(user) + 3)
    return rows.select(
        "*",
        tz.alias("tz_change_signal"),
        F.when(F.col("qc_core_very_low_activity"), partial).otherwise(F.lit(0.0)).alias("partial_signal_raw"),
        travel.alias("travel_signal_raw"),
    )


def deltas(rows: DataFrame, part: list[str]) -> DataFrame:
    """Differences and relative differences to the user's previous row."""
    user = Window.partitionBy(*part).orderBy("date")

    def previous(c: str) -> Column:
        return F.lag(F.col(c).cast("double")).over(user)

    def diff(c: str) -> Column:
        return F.col(c).cast("double") - previous(c)

    return rows.select(
        "*",
        *[diff(c).alias(f"{c}_d1") for c in DELTA_COLUMNS],
        *[(diff(c) / (F.abs(previous(c)) + 1e-6)).alias(f"{c}_r1") for c in RATIO_COLUMNS],
    )


def add_signals_and_deltas(daily: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Context signals and then the differences, of these too: a row looks back on two rows, so one numbering serves both."""
    return windowed(daily, ["uuid"], "date", 2, lambda rows, part: deltas(context_signals(rows, part), part), cfg.segment_rows)


def features_of_blocks(blocks: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The daily feature table of :func:`daily_blocks`."""
    return add_signals_and_deltas(add_quality_flags(with_presence(blocks), cfg), cfg)


def daily_features(events: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The whole daily feature table of standard events."""
    return features_of_blocks(daily_blocks(events, cfg), cfg)
