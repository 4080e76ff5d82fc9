"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in a fixed shuffled order, form blocks of ``block_rows``.  A
source with integer weight a among a total of L gives its j-th block the release
time floor((j-1)L/a) and the deadline ceil(jL/a).  Every slot takes, among the
released blocks, the one with the earliest deadline (ties: source name).  The
weights add up to one, so no block misses its deadline and after t slots every
source has had t*a/L blocks to within less than one.  The schedule repeats after
L slots, so one cycle of L slots is computed (by a fold over a sequence) and every block
finds its slot by arithmetic.  All rows are kept: when a source has
no blocks left its slots are skipped and the others keep their own shares.

``position`` (from 0, without gaps) is the place of a row in the mixture.  It is
computed from per-source counts; there is no global sort or row number.

A slot of the cycle is kept as its source and one bit a source: how many blocks a source
had before slot t is floor(t*a/L), or one more where its bit is set.  That table is broadcast
where its size, known from the number of sources and the sum of weights, is at most ``BROADCAST_BITS``, and
joined by a shuffle on (source, place in the cycle) otherwise; there is no limit on either number.

Cases: a null source is a source of its own, named ''; a row with a null doc_id
takes its place by its text; rows equal in doc_id are ordered by text; repeated
rows are all kept; an empty table gives an empty result; all columns of the
input come along, and where one of them is called ``mix`` the new column is ``mix_``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import free_name, materialise

#: About 16 MB of bits and as much of slots.
BROADCAST_BITS = 1 << 27
#: Slots that are folded at once.
CHUNK = 512


@dataclass(frozen=True)
class MixConfig:
    """Integer target weights by source; a source that isn't listed has ``default_weight``."""

    weights: dict[str, int] = field(default_factory=dict)
    default_weight: int = 1
    block_rows: int = 16


def _weight(source, cfg: MixConfig):
    """The source's weight over the greatest common divisor of all."""
    common = math.gcd(cfg.default_weight, *cfg.weights.values())
    out = F.lit(cfg.default_weight // common)
    for name, weight in cfg.weights.items():
        out = F.when(source == name, F.lit(weight // common)).otherwise(out)
    return out.cast("long")


def _cycle(sources: DataFrame) -> DataFrame:
    """One row: names, weights, counts, total and the cycle's slots in chunks (source number, bits)."""
    one = sources.agg(F.array_sort(F.collect_list(F.struct("source", "weight", "n"))).alias("s"))
    one = one.where(F.size("s") > 0).select(
        F.col("s.source").alias("names"),
        F.col("s.weight").alias("weights"),
        F.col("s.n").alias("counts"),
        F.aggregate("s.weight", F.lit(0).cast("long"), lambda t, w: t + w).alias("total"),
    )
    chunk = "array<struct<source:int,bits:array<bigint>>>"
    words = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 62).cast("int"))

    def step(state, t):
        due = F.transform(
            F.col("weights"),
            lambda a, i: F.when(
                F.floor(F.get(state["done"], i) * F.col("total") / a) <= t,
                F.struct(F.ceil((F.get(state["done"], i) + 1) * F.col("total") / a).alias("deadline"), i.alias("i")),
            ),
        )
        ahead = F.zip_with(state["done"], "weights", lambda d, a: d - F.floor(t * a / F.col("total")))
        bits = F.transform(
            words,
            lambda w: F.aggregate(F.slice(ahead, w * 62 + 1, F.lit(62)), F.lit(0).cast("long"), lambda acc, b: acc * 2 + b),
        )

        def advance(pick):
            return F.struct(
                F.transform(state["done"], lambda d, i: d + F.when(i == pick, 1).otherwise(0).cast("long")).alias("done"),
                F.concat(state["slots"], F.array(F.struct(pick.alias("source"), bits.alias("bits")))).cast(chunk).alias("slots"),
            )

        # as a lambda's variable the choice is computed once a slot, not once for each source
        return F.get(F.transform(F.array(F.array_min(due)["i"]), advance), F.lit(0))

    def chunk_step(state, c):
        ts = F.sequence(c * CHUNK, F.least((c + 1) * CHUNK, F.col("total")) - 1)
        inner = F.struct(state["done"].alias("done"), F.array().cast(chunk).alias("slots"))
        return F.aggregate(
            ts, inner, step, lambda s: F.struct(s["done"].alias("done"), F.concat(state["chunks"], F.array(s["slots"])).cast(f"array<{chunk}>").alias("chunks"))
        )

    start = F.struct(F.transform("weights", lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast(f"array<{chunk}>").alias("chunks"))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / CHUNK))
    return one.withColumn("chunks", F.aggregate(chunks, start, chunk_step, lambda s: s["chunks"]))


def _had(p, bits, weights, total):
    """How many blocks each source had before slot ``p`` of the cycle."""

    def bit(i):
        word = F.floor(i / 62).cast("int")
        length = F.least(F.size(weights) - word * 62, F.lit(62))  # bits of this word, the first source's highest
        down = F.call_function("shiftright", F.get(bits, word), (length - 1 - F.pmod(i, F.lit(62))).cast("int"))
        return down.bitwiseAND(F.lit(1).cast("long"))

    return F.transform(weights, lambda a, i: F.floor(p * a / total) + bit(i))


def _text_ranks(rows: DataFrame) -> DataFrame:
    """(source, digest, text_md5, text_rank): the order of the different texts that share a source and a digest; other rows have no rank.

    Digests shared by different texts are few in most tables; they, and their ranks, are written first, so that Spark knows
    the sizes and texts travel only if they are many.
    """
    shared = rows.groupBy("source", "digest").agg((F.min("text_md5") != F.max("text_md5")).alias("differ")).where("differ").drop("differ")
    shared = materialise(shared, "shared-digests")
    texts = rows.select("source", "digest", "text_md5", "text").join(shared, ["source", "digest"], "left_semi").distinct()
    rank = F.row_number().over(Window.partitionBy("source", "digest").orderBy("text")).alias("text_rank")
    return materialise(texts.select("source", "digest", "text_md5", rank), "text-ranks")


def schedule(
    docs: DataFrame, cfg: MixConfig, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", carried: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with a struct column ``mix``: source, row, block, release, deadline, slot, position.

    ``carried`` are the columns that come along, all by default; without the text among them, texts don't travel.
    """
    carried = list(docs.columns if carried is None else carried)
    doc_id, text = F.col(id_col).cast("string"), F.col(text_col)
    source, digest = F.coalesce(F.col(source_col), F.lit("")), F.md5(F.coalesce(doc_id, text, F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc"),
        source.alias("source"),
        digest.alias("digest"),
        F.substring(digest, 1, 3).alias("bucket"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    if text_col in carried:  # the text goes once, in its row
        rows = rows.drop("text")
        order = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    else:
        rows = rows.withColumn("text_md5", F.md5(F.col("text").cast("binary")))
        rows = rows.drop("text").join(_text_ranks(rows), ["source", "digest", "text_md5"], "left")
        order = F.col("text_rank")
    # rows of a source are numbered bucket by bucket, so that no task holds a whole source
    counts = docs.select(source.alias("source"), F.substring(digest, 1, 3).alias("bucket"))
    counts = counts.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = (
        rows.withColumn("place", F.row_number().over(Window.partitionBy("source", "bucket").orderBy("digest", order)))
        .join(offsets, ["source", "bucket"])
        .select("doc", "source", (F.col("offset") + F.col("place") - 1).alias("row"))
    )

    sources = counts.groupBy("source").agg(F.sum("n").alias("n")).withColumn("weight", _weight(F.col("source"), cfg))
    size = sources.agg(F.count("*").alias("sources"), F.sum("weight").alias("total")).first()
    cycle = _cycle(sources)
    slots = cycle.select("names", "weights", "total", F.posexplode("chunks").alias("c", "slots"))
    slots = slots.select("names", "weights", "total", "c", F.posexplode("slots").alias("o", "slot"))
    slots = slots.withColumn("p", F.col("c").cast("long") * CHUNK + F.col("o"))
    had = _had(F.col("p"), F.col("slot.bits"), F.col("weights"), F.col("total"))
    slots = slots.select(
        F.get("names", F.col("slot.source")).alias("source"), F.get(had, F.col("slot.source")).alias("turn"), "p", F.col("slot.bits").alias("bits")
    )
    if (size["sources"] or 0) * (size["total"] or 0) <= BROADCAST_BITS:
        slots = F.broadcast(slots)
    block = F.floor(F.col("row") / cfg.block_rows)
    weights = numbered.withColumn("block", block).withColumn("turn", F.pmod("block", _weight(F.col("source"), cfg)))
    weights = weights.withColumn("weight", _weight(F.col("source"), cfg))
    shares = cycle.select("weights", "counts", "total")  # one row of two numbers a source
    placed = weights.join(slots, ["source", "turn"]).crossJoin(F.broadcast(shares)).withColumn("round", F.floor(F.col("block") / F.col("weight")))
    had = _had(F.col("p"), F.col("bits"), F.col("weights"), F.col("total"))
    share = F.zip_with(had, "weights", lambda b, a: (b + F.col("round") * a) * cfg.block_rows)
    earlier = F.aggregate(F.zip_with(share, "counts", lambda b, n: F.least(b, n)), F.lit(0).cast("long"), lambda t, x: t + x)
    return placed.select(
        "doc.*",
        F.struct(
            "source",
            F.col("row").cast("long").alias("row"),
            (F.col("block") + 1).alias("block"),
            F.floor(F.col("block") * F.col("total") / F.col("weight")).alias("release"),
            F.ceil((F.col("block") + 1) * F.col("total") / F.col("weight")).alias("deadline"),
            (F.col("round") * F.col("total") + F.col("p")).alias("slot"),
            (earlier + F.pmod("row", F.lit(cfg.block_rows))).cast("long").alias("position"),
        ).alias(free_name("mix", carried)),
    )


def mixed(docs: DataFrame, cfg: MixConfig, partitions: int, position: str | None = None) -> DataFrame:
    """The rows of ``docs``, all of them, laid out in the order of the mixture.

    Files of a table are not read back in the order they were written in; with
    ``position`` a column of that name has each row's place as well.
    """
    name = free_name("mix", docs.columns)
    at = F.col(f"{name}.position")
    out = schedule(docs, cfg).repartitionByRange(partitions, at).sortWithinPartitions(at)
    return (out.withColumn(position, at) if position else out).drop(name)
