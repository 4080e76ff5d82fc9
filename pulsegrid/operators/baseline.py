"""Each day against the user's own past: flags, rolling baselines and z-scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.config import Z_COLUMNS, PipelineConfig
from pulsegrid.functions.columns import clip
from pulsegrid.functions.quantiles import exact_quantiles
from pulsegrid.operators.features import BLOCKS
from pulsegrid.operators.segments import numbered, of_key, windowed
from pulsegrid.sources.tables import settle


def all_of(columns: list[Column]) -> Column:
    return reduce(Column.__and__, columns, F.lit(True))


#: Columns that a feature table may lack.
_DEFAULTS = {
    "boolean": ("has_activity", "qc_core_low_cov", "qc_rhythm_low_cov", "qc_gap_low_cov"),
    "double": ("daily_event_cnt", "unlock_cnt", "heartbeat_cnt", "partial_signal_raw", "travel_signal_raw", "tz_change_signal"),
}
#: The block that a base column belongs to; the others are in every table.
_BLOCK_OF = {c: b for b in ("rhythm", "gap", "session", "mobility") for c in BLOCKS[b]}


def with_defaults(features: DataFrame) -> DataFrame:
    """The table with nulls in columns that it lacks."""
    needed = {c: kind for kind, cols in _DEFAULTS.items() for c in cols} | {c: "double" for c in PipelineConfig().base_columns}
    return features.withColumns({c: F.lit(None).cast(kind) for c, kind in needed.items() if c not in features.columns})


def present_columns(features: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> tuple[str, ...]:
    """The base columns whose block any row of the table has: one aggregate.

    A block that nobody has isn't asked for; one that some users have is asked for of all.  Where the table doesn't say
    which blocks a row has, a value in one of the block's columns does.
    """
    there = {}
    for block in {_BLOCK_OF[c] for c in cfg.base_columns if c in _BLOCK_OF}:
        signs = [F.coalesce(f"has_{block}", F.lit(False))] if f"has_{block}" in features.columns else []
        signs += [F.col(c).isNotNull() for c in BLOCKS[block] if c in features.columns]
        there[block] = F.max(reduce(Column.__or__, signs, F.lit(False)))
    found = features.agg(*[c.alias(b) for b, c in there.items()]).first().asDict() if there else {}
    return tuple(c for c in cfg.base_columns if c not in _BLOCK_OF or found[_BLOCK_OF[c]])


def prepare(features: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Day index, cold-start stage, context and quality of each day, and which days baselines learn from."""
    features = of_key(with_defaults(features), ["uuid"], {"_first": F.min("date")}, cfg.segment_rows)
    day = F.datediff("date", "_first") + 1
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("daily_event_cnt", "unlock_cnt", "session_cnt", "heartbeat_cnt")}
    filled["step_sum"] = F.coalesce("step_sum", F.lit(0.0))
    filled["gap_max"] = F.coalesce("gap_max", F.when(F.coalesce("daily_event_cnt", F.lit(0)) == 0, F.lit(24.0)))
    tz = F.coalesce("tz_change_signal", F.lit(0.0)) >= cfg.tz_level
    rows = features.where("uuid is not null and date is not null").withColumns(filled)
    rows = rows.withColumns(
        {
            "is_weekend": F.weekday("date") >= 5,
            "day_idx": day,
            "qc_missing_any": F.col("qc_core_low_cov").isNull() | F.col("qc_rhythm_low_cov").isNull() | F.col("qc_gap_low_cov").isNull(),
            "qc_any_low_cov": reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c in ("qc_core_low_cov", "qc_rhythm_low_cov", "qc_gap_low_cov")]),
            "partial_flag": F.coalesce("partial_signal_raw", F.lit(0.0)) >= cfg.partial_level,
            "tz_flag": tz,
            "travel_flag": (F.coalesce("travel_signal_raw", F.lit(0.0)) >= cfg.travel_level) | tz,
        }
    )
    rows = rows.drop("_first")
    i, partial, travel = F.col("day_idx"), F.col("partial_flag"), F.col("travel_flag")
    low = F.col("qc_any_low_cov") | F.col("qc_missing_any")
    flags = F.concat_ws("|", F.when(partial, "PARTIAL"), F.when(travel, "TRAVEL"))
    return rows.withColumns(
        {
            "cold_stage": F.when(i <= 4, "ONBOARD").when(i <= 8, "WARMUP").when(i <= 15, "SEMI_READY").otherwise("READY"),
            "context_mode": F.coalesce(F.nullif(flags, F.lit("")), F.lit("NORMAL")),
            "quality_state": F.when(low, "LOW_CONF").otherwise("GOOD"),
            "baseline_fit": F.coalesce("has_activity", F.lit(False)) & ~low & ~partial & ~travel,
        }
    )


def winsor_bounds(prepared: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """One row: count and outer quantiles of each base column over all days that baselines learn from."""
    x = {c: F.when(F.col("baseline_fit"), F.col(c).cast("double")) for c in cfg.base_columns}
    return exact_quantiles(prepared, x, cfg.winsor)


def winsorised(prepared: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds ``<column>_w``: the value on days that baselines learn from, between the outer quantiles."""
    prepared = settle(prepared, "prepared")  # read twice: for the bounds and for the rows
    bounds = winsor_bounds(prepared, cfg)
    rows = prepared.crossJoin(F.broadcast(bounds))  # one row
    out = []
    for c in cfg.base_columns:
        x = F.when(F.col("baseline_fit"), F.col(c).cast("double"))
        out.append(F.when(F.col(f"{c}_n") >= cfg.winsor_least, clip(x, F.col(f"{c}_q")[0], F.col(f"{c}_q")[1])).otherwise(x).alias(f"{c}_w"))
    return rows.select(*[f"`{c}`" for c in prepared.columns], *out)


def _measured(x: np.ndarray, there: np.ndarray, at: np.ndarray, before: np.ndarray, frames: Sequence[tuple[int, int]], least_std: np.ndarray) -> pa.Array:
    """For each place ``at`` in the rows ``x``: means and deviations over its last rows, of the ``before`` rows that are its own."""
    steps = [np.flatnonzero(before >= j) for j in range(1, max(n for n, _ in frames) + 1)]
    total, count, sums = np.zeros((len(at), x.shape[1])), np.zeros((len(at), x.shape[1])), {}
    made: list[np.ma.MaskedArray] = []
    with np.errstate(all="ignore"):
        for j, has in enumerate(steps, 1):
            total[has] += x[at[has] - j]
            count[has] += there[at[has] - j]
            if any(n == j for n, _ in frames):
                sums[j] = (total / count, count.copy())
        for n, least in frames:
            mean, values = sums[n]
            squares = np.zeros_like(mean)
            for j, has in enumerate(steps[:n], 1):
                off = np.where(there[at[has] - j], x[at[has] - j] - mean[has], 0.0)
                squares[has] += off * off
            std = np.maximum(np.sqrt(squares / values), least_std)
            known = (values >= least) & (values > 0)
            made += [np.ma.array(mean, mask=~known), np.ma.array(np.where(known, std, least_std))]
    return _listed(made)


def _in_order(x: np.ndarray, there: np.ndarray, at: np.ndarray, before: np.ndarray, frames: Sequence[tuple[int, int]], least_std: np.ndarray) -> pa.Array:
    """The same, with each frame's values taken oldest first and their squares about the mean so far (Welford).

    SQL takes its averages and deviations so. Columns whose z-scores are equal but for rounding are told apart by the last bits
    of their deviations, so the top feature of such a day hangs on the order too.
    """
    made: list[np.ma.MaskedArray] = []
    with np.errstate(all="ignore"):
        for n, least in frames:
            total, values, so_far, squares = (np.zeros((len(at), x.shape[1])) for _ in range(4))
            for j in range(n, 0, -1):
                has = np.flatnonzero(before >= j)
                new, known, mean = x[at[has] - j], there[at[has] - j], so_far[has]
                total[has] += new
                values[has] += known
                off = np.where(known, new - mean, 0.0)
                moved = mean + off / np.maximum(values[has], 1)
                squares[has] += np.where(known, (new - moved) * off, 0.0)
                so_far[has] = moved
            std = np.maximum(np.sqrt(squares / values), least_std)
            known = (values >= least) & (values > 0)
            made += [np.ma.array(total / values, mask=~known), np.ma.array(np.where(known, std, least_std))]
    return _listed(made)


def _listed(made: Sequence[np.ma.MaskedArray]) -> pa.Array:
    """One array of all columns' values for each row."""
    out = np.ma.concatenate(made, axis=1)
    offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(out.data.ravel(), mask=np.ma.getmaskarray(out).ravel()))


def _matrix(flat: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values by row, a missing one as zero, and which are there."""
    there = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.where(there, flat.to_numpy(zero_copy_only=False).reshape(-1, width), 0.0), there


def frame_stats(frames: Sequence[tuple[int, int]], floors: Sequence[float]) -> Callable[[Column], Column]:
    """A function of the rows before a day, oldest first, each an array of values: means and deviations over the last rows.

    For each frame (rows, least number of values) the result has the means of all columns, then their deviations. A mean of fewer
    values is null, and a deviation of fewer, or one below it, is the column's floor.
    """
    least_std = np.array(floors)

    @F.arrow_udf("array<double>")
    def stats(before: pa.Array) -> pa.Array:
        lengths = before.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return _measured(*_matrix(before.flatten().flatten(), len(least_std)), np.cumsum(lengths), lengths, frames, least_std)

    return stats


def running_stats(frames: Sequence[tuple[int, int]], floors: Sequence[float]) -> Callable[[Column, Column], Column]:
    """The same of (number of a row in its key, from 0; array of its values), where rows come in the order of key and number.

    Values are taken in that order, to the last bit as SQL takes them. A row is sent once, however many look back on it; the last rows of a batch stay for the next one. As a value hangs on the rows
    before, the function is no deterministic one: rows must not be dropped before it.
    """
    least_std, reach = np.array(floors), max(n for n, _ in frames)

    @F.arrow_udf("array<double>")
    def stats(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        x, there, last = np.zeros((0, len(least_std))), np.zeros((0, len(least_std)), bool), -1
        for number, values in batches:
            before = number.to_numpy(zero_copy_only=False).astype(np.int64)
            if np.any((before != 0) & (before != np.append(last, before[:-1]) + 1)):
                raise ValueError("rows aren't in the order of their numbers")
            kept, (mine, known) = len(x), _matrix(values.flatten(), len(least_std))
            x, there = np.concatenate([x, mine]), np.concatenate([there, known])
            yield _in_order(x, there, kept + np.arange(len(before)), before, frames, least_std)
            x, there, last = x[-reach:], there[-reach:], before[-1] if len(before) else last

    return stats.asNondeterministic()


def rolling_baselines(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Long, short (all days; by kind of day) and early baselines, with the fallbacks between their means.

    The mean of the rows before needs a least number of values; without it, or where it is less, a deviation is its floor.
    A deviation never falls back: its floor stands in first.  Rows are numbered within their window's key and measured in that
    order, a batch of days at once and a row sent once for all frames. All windows share one
    exchange by user, or get the rows that they look back on as the halo of a segment.
    """
    lt, st, split = (cfg.lt_window, cfg.lt_least), (cfg.st_window, cfg.st_least), (cfg.st_window, cfg.st_split_least)
    early = (cfg.early_window, cfg.early_least)
    values = F.array(*[F.col(f"{c}_w") for c in cfg.base_columns])
    floors = [cfg.floor(c) for c in cfg.base_columns]
    if cfg.segment_rows is not None:  # both numbers from one dealing
        rows = numbered(rows, ["uuid"], "date", "_of_user", [("_of_kind", ["is_weekend"])])
    for keys, rank, kinds in ((["uuid"], "_of_user", (("lt_g", lt), ("st_g", st), ("early_g", early))), (["uuid", "is_weekend"], "_of_kind", (("st_own", split), ("early_own", early)))):
        reach = max(n for _, (n, _) in kinds)
        stats = running_stats([frame for _, frame in kinds], floors)

        def add(df: DataFrame, part: list[str], stats=stats) -> DataFrame:
            number = F.row_number().over(Window.partitionBy(*part).orderBy("date")) - 1
            return df.withColumn("_before", number).select("*", stats("_before", values).alias("_stats")).drop("_before")

        names = [f"{c}_{x}_{kind}" for kind, _ in kinds for x in ("mean", "std") for c in cfg.base_columns]
        columns = [c for c in rows.columns if c != rank]
        rows = windowed(rows, keys, "date", reach, add, cfg.segment_rows, rank)
        rows = rows.select(*[f"`{c}`" for c in columns], *[F.get("_stats", F.lit(i)).alias(n) for i, n in enumerate(names)])
    out = []
    for c in cfg.base_columns:
        st_s = F.coalesce(f"{c}_mean_st_own", f"{c}_mean_st_g", f"{c}_mean_lt_g")
        early_s = F.coalesce(f"{c}_mean_early_own", f"{c}_mean_early_g")
        out += [
            st_s.alias(f"{c}_mean_st_s"),
            F.col(f"{c}_std_st_own").alias(f"{c}_std_st_s"),
            early_s.alias(f"{c}_mean_early_s"),
            F.col(f"{c}_std_early_own").alias(f"{c}_std_early_s"),
            F.coalesce(st_s, early_s).alias(f"{c}_mean_final"),
            F.col(f"{c}_std_st_own").alias(f"{c}_std_final"),
        ]
    fell = reduce(Column.__or__, [F.col(f"{c}_mean_st_own").isNull() for c in cfg.base_columns])
    rows = rows.select("*", *out, fell.alias("fallback_any_stsplit"))
    return rows.withColumns(
        {
            "baseline_ready": all_of([F.col(f"{c}_mean_st_s").isNotNull() for c in cfg.base_columns]),
            "early_ready": all_of([F.col(f"{c}_mean_early_s").isNotNull() for c in cfg.base_columns]),
        }
    )


def soft_z(x: Column, mean: Column, std: Column, limit: float) -> Column:
    return F.lit(limit) * F.tanh((x - mean) / std / F.lit(limit))


def z_scores(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds ``scored`` (a good day with a baseline) and ``<column>_z`` on such days."""
    rows = rows.withColumn("scored", F.col("baseline_ready") & (F.col("quality_state") == "GOOD"))
    z = [c for c in Z_COLUMNS if c in cfg.base_columns]
    made = [F.when(F.col("scored"), soft_z(F.col(c).cast("double"), F.col(f"{c}_mean_st_s"), F.col(f"{c}_std_st_s"), cfg.z_clip)).alias(f"{c}_z") for c in z]
    return rows.select("*", *made)


def baselines(features: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Daily features with flags, baselines and z-scores, of the base columns that the table has."""
    cfg = replace(cfg, base_columns=present_columns(features, cfg))
    return z_scores(rolling_baselines(winsorised(prepare(features, cfg), cfg), cfg), cfg)
