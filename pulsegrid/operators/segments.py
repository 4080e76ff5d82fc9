"""Windows over long keys in segments, so that no task holds all rows of a key.

Rows are dealt by range of (key, order) and numbered by the counts of the ranges before.
A segment is a run of consecutive numbers of one key:

* windows of bounded reach (:func:`windowed`) get the rows before a segment that they look back on
  as copies, its halo, and give them up afterwards;
* running affine maps (:func:`running_maps`) are folded within segments, and the folded segments
  are rows of the same problem, smaller by the size of a segment.

Events of a day are cut by time slots (:func:`cut_days`); what a segment has to tell its
successors then is a row of a few values, see ``features``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.tables import settle


def cut_days(events: DataFrame, limit: int, slot_ms: int) -> tuple[DataFrame, bool]:
    """Adds ``seg`` to events of (uuid, date) with more than ``limit`` rows: its number within the day, in the order of time.

    A segment has about ``limit`` events, and all events of a slot of ``slot_ms``.  One count a
    day decides which days are cut at all; the answer comes as the second value.  Where no user has
    so many events in all, which takes no dates, no day has.
    """
    if events.groupBy("uuid").agg(F.count("*").alias("n")).where(F.col("n") > limit).isEmpty():
        return events, False
    full = events.groupBy("uuid", "date").agg(F.count("*").alias("n")).where(F.col("n") > limit).drop("n")
    if full.isEmpty():
        return events, False
    full = settle(full, "full-days")
    slot = F.floor(F.col("ms") / slot_ms)
    counts = events.join(full, ["uuid", "date"], "left_semi").groupBy("uuid", "date", slot.alias("slot")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("uuid", "date").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    starts = counts.withColumn("seg", F.floor(before / limit)).groupBy("uuid", "date", "seg").agg(F.min("slot").alias("slot"))
    starts = settle(starts.groupBy("uuid", "date").agg(F.sort_array(F.collect_list("slot")).alias("starts")), "segments")
    seg = F.size(F.filter("starts", lambda s: s <= slot)) - 1
    cut = events.join(starts, ["uuid", "date"], "left").withColumn("seg", F.when(F.col("starts").isNull(), 0).otherwise(seg))
    return cut.drop("starts"), True


def numbered(rows: DataFrame, keys: Sequence[str], order: str, name: str = "_rank", finer: Sequence[tuple[str, Sequence[str]]] = ()) -> DataFrame:
    """Adds the number of each row within its key, from 0 in the given order.

    ``finer`` are further names, each with columns that divide the keys: ranges of (keys, order) are in order within these too,
    so rows are dealt and written once for all numbers.
    """
    dealt = settle(rows.repartitionByRange(*keys, order).withColumn("_range", F.spark_partition_id()), "ranges")
    out = dealt
    for name, own in ((name, [*keys]), *[(n, [*keys, *more]) for n, more in finer]):
        counts = dealt.groupBy(*own, "_range").agg(F.count("*").alias("_n"))  # a row a key and range
        before = F.sum("_n").over(Window.partitionBy(*own).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
        counts = counts.select(*own, "_range", before.alias("_before"))
        joined = out.alias("l").join(counts.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*own, "_range")])
        within = F.row_number().over(Window.partitionBy(*[f"l.{k}" for k in own], "l._range").orderBy(f"l.{order}"))
        out = joined.select("l.*", (F.col("r._before") + within - 1).alias(name))
    return out.drop("_range")


def windowed(rows: DataFrame, keys: Sequence[str], order: str, reach: int, compute: Callable[[DataFrame, list[str]], DataFrame], size: int | None, rank: str | None = None) -> DataFrame:
    """``compute(rows, partition columns)``, whose windows look back ``reach`` rows at most, over segments of ``size`` rows.

    Without a size the windows are over whole keys. ``rank`` is the column of :func:`numbered`, where the rows have it already; it goes.
    """
    if size is None:
        return compute(rows, [*keys])
    ranked = numbered(rows, keys, order) if rank is None else rows.withColumnRenamed(rank, "_rank")
    copies = F.sequence(F.floor(F.col("_rank") / size), F.floor((F.col("_rank") + reach) / size))
    done = compute(ranked.withColumn("_seg", F.explode(copies)), [*keys, "_seg"])
    return done.where(F.col("_seg") == F.floor(F.col("_rank") / size)).drop("_seg", "_rank")


def of_key(rows: DataFrame, keys: Sequence[str], columns: dict[str, Column], size: int | None) -> DataFrame:
    """Adds aggregates over all rows of a key; with a size they come from partial aggregates and a join, and no task holds a key."""
    if size is None:
        whole = Window.partitionBy(*keys)
        return rows.select("*", *[c.over(whole).alias(n) for n, c in columns.items()])
    known = settle(rows.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()]), "of-key")
    joined = rows.alias("l").join(known.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], "left")
    return joined.select("l.*", *[f"r.{n}" for n in columns])


def _after(first: Column, then: Column) -> Column:
    """The map that does ``then`` what ``first`` has done; ``alone`` is its value where nothing came before."""
    return F.struct(
        (first["scale"] * then["scale"]).alias("scale"),
        (then["scale"] * first["shift"] + then["shift"]).alias("shift"),
        F.when(first["alone"].isNull(), then["alone"]).otherwise(then["scale"] * first["alone"] + then["shift"]).alias("alone"),
    )


def running_maps(rows: DataFrame, keys: Sequence[str], rank: str, move: str, longest: int, size: int) -> DataFrame:
    """Replaces the map in column ``move`` by that of all rows of the key up to this one.

    A map is a struct of doubles (scale, shift, alone): ``scale * y + shift``, or ``alone``
    where there is no y yet.  ``rank`` numbers a key's rows from 0 and is below ``longest``.
    Maps compose associatively: a segment of ``size`` rows is folded, and
    where there are several, their folds are the rows of the next level.
    """
    nothing = F.struct(F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"), F.lit(None).cast("double").alias("alone"))
    group = F.floor(F.col(rank) / size).alias("_group")
    so_far = Window.partitionBy(*keys, "_group").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    folded = F.aggregate(F.collect_list(move).over(so_far), nothing, _after)
    rows = rows.select("*", group).withColumn(move, folded)
    if longest <= size:
        return rows.drop("_group")
    rows = settle(rows, "maps")
    ends = rows.groupBy(*keys, F.col("_group").alias("_at")).agg(F.max_by(move, rank).alias("_carried"))
    ends = running_maps(ends, keys, "_at", "_carried", -(-longest // size), size)
    ends = ends.select(*keys, (F.col("_at") + 1).alias("_group"), "_carried")  # what the segments before a segment have done
    joined = rows.alias("l").join(ends.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "_group")], "left")
    total = F.when(F.col("r._carried").isNull(), F.col(f"l.{move}")).otherwise(_after(F.col("r._carried"), F.col(f"l.{move}")))
    return joined.select(*[total.alias(c) if c == move else F.col(f"l.`{c}`") for c in rows.columns if c != "_group"])


def smoothed(rows: DataFrame, keys: Sequence[str], order: str, value: str, alpha: float, name: str, size: int | None, fold: int = 256) -> DataFrame:
    """Adds the exponential mean of the key's values so far; a row without a value keeps the one before it.

    Exact for any number of rows and any ``alpha``; ``size`` is that of :func:`windowed`, which here
    only says whether rows are numbered over whole keys or over ranges.
    """
    if size is None:
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    else:
        ranked = numbered(rows, keys, order)
    x = F.col(value)
    one = F.struct(
        F.when(x.isNull(), 1.0).otherwise(1.0 - alpha).alias("scale"),
        F.when(x.isNull(), 0.0).otherwise(alpha * x).alias("shift"),
        x.cast("double").alias("alone"),
    )
    ranked = settle(ranked.withColumn("_move", one), "ranked")
    longest = ranked.agg(F.coalesce(F.max("_rank"), F.lit(0)).alias("m")).first()["m"] + 1
    done = running_maps(ranked, keys, "_rank", "_move", longest, size or fold)
    return done.withColumn(name, F.col("_move.alone")).drop("_rank", "_move")
