"""Repeated fixed-length windows of symbols, found through super-k-mers.

A window of ``width`` symbols (words or bytes) has a minimiser: the leftmost
k-gram of least hash in it.  Consecutive windows with the same minimiser
position form a run (super-k-mer); equal windows have equal minimisers, so
they meet in the bucket of that minimiser.  The steps:

1. list the runs of every document (numbers for the minimiser and for the run's
   symbols, and a place); keep those whose minimiser occurs more than once;
2. equal runs are aggregated to their first occurrence before they travel any
   further: of all others it is known that every window is repeated;
3. where several different runs have one minimiser, they are cut out of the
   texts, packed as one byte string each, and sent to their bucket;
4. buckets are compared window by window (the caller's part); those of more than
   ``GROUP`` different runs fall apart into windows, equal ones again aggregated first;
5. the verdicts go back to the documents as ranges of window starts.

Exact copies of a whole text are set aside in step 1 and only the first goes
through the search.  A minimiser, run, window or text that a large share of
rows has is never gathered in one task: partial aggregates take it down before a
shuffle, and joins against it read two written tables, which lets Spark split the
large side of a skewed partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text
from ._shared import discard, materialise, release_shuffles

#: Symbols handled at once; longer documents go through in overlapping pieces.
PIECE = 1 << 20
#: Different strings of a minimiser that are compared as one group; larger buckets are split by window.
GROUP = 2500
#: Packed bytes that are compared at once, besides one bucket.
JUDGED_BYTES = 50_000
_PLACE = np.uint64((1 << 24) - 1)


@dataclass(frozen=True)
class Unit:
    """What a symbol is: ``word`` or ``byte``; windows of ``width``, minimisers of ``k`` symbols."""

    kind: str
    width: int
    k: int


def canonical_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends): the words joined by one space, and where each lies in it."""
    starts, ends = _text.word_spans(data)
    if not len(starts):
        return data[:0], starts, ends
    lengths = ends - starts
    to = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(lengths) - 1, 0x20, np.uint8)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[inner + np.repeat(to, lengths)] = data[inner + np.repeat(starts, lengths)]
    return out, to, to + lengths


def _grams(data: np.ndarray, unit: Unit) -> np.ndarray:
    if unit.kind == "word":
        return _text.windows_hash(_text.span_hashes(data, *_text.word_spans(data)), unit.k)
    n = len(data) - unit.k + 1  # bytes: k is a multiple of 8, so many unaligned words
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = np.zeros((len(data) + 7) // 8 * 8, np.uint8)
    padded[: len(data)] = data
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint64), (len(data) - 7,), (1,), writeable=False)
    out = np.zeros(n, np.uint64)
    for j in range(0, unit.k, 8):
        out = _text.mix(out * np.uint64(0x9E3779B97F4A7C15) + eight[j : j + n])
    return out


def runs_of(data: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, hash of all symbols, first window, number of windows) of each run of one text."""
    grams, span = _grams(data, unit), unit.width - unit.k + 1
    found = []
    for at in range(0, max(0, len(grams) - span + 1), PIECE):
        part = grams[at : at + PIECE + span - 1]
        least = _text.sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), span) & _PLACE
        first = np.flatnonzero(np.diff(least, prepend=np.uint64(1 << 40)))
        n = np.diff(first, append=len(least))
        found.append((part[least[first].astype(np.int64)], _text.slice_hashes(part, first, first + n + span - 1), first + at, n))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def row_key() -> Column:
    """Tells rows apart that differ in doc_id, a null one from any number, or text."""
    return F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.coalesce(F.col("text"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, same, doc_id, data): rid tells rows apart that differ in doc_id or text; same is a hash of the text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(row_key().alias("rid"), F.xxhash64(text).alias("same"), doc_id.alias("doc_id"), text.cast("binary").alias("data"))


def _list_runs(rows: DataFrame, unit: Unit) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("gram", "run", "rid", "same", "place")
        for batch in batches:
            held, size = [], 0
            for rid, same, data in zip(batch["rid"], batch["same"], batch["data"]):
                gram, run, start, n = runs_of(np.frombuffer(data, np.uint8), unit)
                held.append((gram.view(np.int64), run.view(np.int64), np.full(len(gram), rid), np.full(len(gram), same), (start << 16) | n))
                size += len(gram)
                if size > 100_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held)))))
                    held, size = [], 0
            if held:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held)))))

    return rows.select("rid", "same", "data").mapInPandas(work, "gram bigint, run bigint, rid bigint, same bigint, place bigint")


def _pack(texts: DataFrame, unit: Unit) -> DataFrame:
    """Cuts the listed runs (array ``runs``) out of each document."""
    names = ["gram", "variants", "at", "rid", "place", "weight", "packed"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for rid, at, data, grams, places, variants, weights in zip(*(batch[c] for c in ("rid", "at", "data", "grams", "places", "variants", "weights"))):
                places = np.asarray(places)
                start, last = places >> 16, (places >> 16) + (places & 0xFFFF) + unit.width - 2
                if unit.kind == "word":
                    raw, froms, tos = canonical_words(np.frombuffer(data, np.uint8))
                    data, start, last = raw.tobytes(), froms[start], tos[last] - 1
                each = zip(np.asarray(grams).tolist(), np.asarray(variants).tolist(), places.tolist(), np.asarray(weights).tolist(), start.tolist(), last.tolist())
                out += [(gram, variant, at, rid, place, weight, data[a : b + 1]) for gram, variant, place, weight, a, b in each]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    return texts.mapInPandas(work, "gram bigint, variants bigint, at bigint, rid bigint, place bigint, weight bigint, packed binary")


def copies_of(rows: DataFrame) -> DataFrame:
    """(rid, at, copies, first): rows with the same text, and whether this one is the first by ``at``, the doc_id (nulls last)."""
    ids = materialise(rows.select("rid", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("at"), F.sha2("data", 256).alias("sha")), "ids")
    first = ids.groupBy("sha").agg(F.min("at").alias("f_at"), F.count("*").alias("copies"))
    first = materialise(first.where("copies > 1"), "first-at")
    # among equal ids (texts are equal here) any row will do: rid is the same
    joined = ids.join(first, "sha", "left").select(
        "rid", "at", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce(F.col("at") == F.col("f_at"), F.lit(True)).alias("first")
    )
    return joined.groupBy("rid").agg(F.max("at").alias("at"), F.max("copies").alias("copies"), F.max("first").alias("first"))


def _aggregated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group of equal runs or windows the first occurrence, whether there are several, and all their weight."""
    place = F.struct("at", "rid", "place")
    return rows.groupBy(*keys).agg(F.min(place).alias("f"), F.max(place).alias("l"), F.sum("weight").alias("weight")).select(
        *keys, "f.*", "weight", (F.col("f") != F.col("l")).alias("several")
    )


def _repeats_of(rows: DataFrame, groups: DataFrame, keys: list[str], keep_first: bool) -> DataFrame:
    """(rid, start, count) of the occurrences that their group alone shows to be repeated."""
    several = groups.where("several" if keep_first else "weight > 1").select(*keys, F.col("rid").alias("f_rid"), F.col("place").alias("f_place"))
    whole = rows.select(*keys, "rid", "place").join(several, keys)
    if keep_first:
        whole = whole.where("rid != f_rid or place != f_place")
    return whole.select("rid", F.shiftright("place", 16).alias("start"), F.col("place").bitwiseAND(0xFFFF).alias("count"))


def repeated_windows(
    docs: DataFrame,
    unit: Unit,
    compare: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]],
    keep_first: bool,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, copies, flagged): ``flagged(rid, ranges)`` has the repeated windows of each first copy as (start, count) structs.

    ``compare`` gets runs (rid, place, weight, packed) of whole buckets in
    document order and returns (row, first window within the run, number) of the
    windows to flag.  With ``keep_first`` the first occurrence of an equal run
    isn't flagged by it, else all are.
    """
    spark = docs.sparkSession
    rows = keyed(docs)
    copies = materialise(copies_of(rows), "copies")
    listed = materialise(_list_runs(rows, unit), "runs")
    where = F.xxhash64("same", "place")  # exact copies of a text don't make its minimisers repeated
    twice = materialise(listed.groupBy("gram").agg(F.min(where).alias("lo"), F.max(where).alias("hi")).where("lo != hi").select("gram"), "grams")
    release_shuffles(spark)
    kept = listed.select("gram", "run", "rid", "place").join(twice, "gram", "left_semi")
    firsts_only = copies.where("first").select("rid", "at", F.col("copies").alias("weight"))
    runs = materialise(kept.join(firsts_only, "rid").select("gram", "run", "at", "rid", "place", "weight"), "repeated-runs")
    discard(listed)
    release_shuffles(spark)

    groups = materialise(_aggregated(runs, ["gram", "run"]), "groups")
    contested = groups.groupBy("gram").agg(F.count("*").alias("variants")).where("variants > 1")
    contested = materialise(contested, "contested")
    lists = [F.collect_list(c).alias(n) for c, n in (("gram", "grams"), ("place", "places"), ("variants", "variants"), ("weight", "weights"))]
    by_doc = groups.join(contested, "gram").groupBy("rid").agg(F.max("at").alias("at"), *lists)
    texts = rows.groupBy("rid").agg(F.any_value("data").alias("data")).join(by_doc, "rid")  # rows that repeat are packed once
    packed = materialise(_pack(texts, unit), "packed")
    release_shuffles(spark)

    flagged = _repeats_of(runs, groups, ["gram", "run"], keep_first).union(_compare_buckets(packed.where(F.col("variants") <= GROUP), compare))
    large = packed.where(F.col("variants") > GROUP)
    if not large.isEmpty():
        windows = materialise(_split_windows(large, unit), "windows")
        equal = materialise(_aggregated(windows, ["gram", "window"]), "equal-windows")
        flagged = flagged.union(_repeats_of(windows, equal, ["gram", "window"], keep_first))
    flagged = materialise(flagged.groupBy("rid").agg(F.collect_set(F.struct("start", "count")).alias("ranges")), "flagged")
    for table in (runs, groups, packed):
        discard(table)
    release_shuffles(spark)
    return rows, copies, flagged


def _split_windows(buckets: DataFrame, unit: Unit) -> DataFrame:
    """Large buckets: a run becomes single windows, each with a digest of its symbols."""
    names = ["gram", "window", "at", "rid", "place", "weight"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import blake2b

        for batch in batches:
            out: list[tuple] = []
            for gram, at, rid, place, weight, packed in zip(*(batch[c] for c in ("gram", "at", "rid", "place", "weight", "packed"))):
                n = place & 0xFFFF
                starts, ends = np.arange(n), np.arange(n) + unit.width
                if unit.kind == "word":
                    starts, ends = _text.word_spans(np.frombuffer(packed, np.uint8))
                    starts, ends = starts[:n], ends[unit.width - 1 :]
                for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                    out.append((gram, blake2b(packed[a:b], digest_size=16).digest(), at, rid, (((place >> 16) + k) << 16) | 1, weight))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    return buckets.mapInPandas(work, "gram bigint, window binary, at bigint, rid bigint, place bigint, weight bigint")


def _compare_buckets(buckets: DataFrame, compare: Callable) -> DataFrame:
    dealt = buckets.select("gram", "at", "rid", "place", "weight", "packed").repartition("gram").sortWithinPartitions("gram")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def judge(held: list[pd.DataFrame]) -> pd.DataFrame:
            runs = pd.concat(held, ignore_index=True).sort_values(["at", "rid", "place"], ignore_index=True)
            row, first, n = compare(runs)
            return pd.DataFrame({"rid": runs["rid"].to_numpy()[row], "start": (runs["place"].to_numpy()[row] >> 16) + first, "count": n})

        held, size, last = [], 0, None
        for batch in batches:
            gram = batch["gram"].to_numpy()
            length = batch["packed"].map(len).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(gram)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if size > JUDGED_BYTES and int(gram[a]) != last:
                    yield judge(held)
                    held, size = [], 0
                held.append(batch.iloc[a:b])
                size += int(length[a:b].sum())
                last = int(gram[a])
        if held:
            yield judge(held)

    return dealt.mapInPandas(work, "rid bigint, start bigint, count bigint")


def removed_mask(n: int, ranges: list[dict], width: int) -> np.ndarray:
    """Which of ``n`` symbols are covered by the flagged windows."""
    starts, counts = np.array([(r["start"], r["count"]) for r in ranges], np.int64).reshape(-1, 2).T
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + counts + width - 1, -1)
    return np.cumsum(step[:n]) > 0


def known_verdicts(copies: DataFrame, flagged: DataFrame) -> DataFrame:
    """(rid, copies, first, ranges) of the rows that have a copy or a flagged window."""
    return copies.join(flagged, "rid", "left").where("not first or copies > 1 or ranges is not null").drop("at")


def with_verdicts(rows: DataFrame, copies: DataFrame, flagged: DataFrame, *columns: str) -> DataFrame:
    """Each row with copies, first and ranges (null where it has none); texts are dealt once."""
    known = known_verdicts(copies, flagged)
    return rows.join(known, "rid", "left").select("rid", "doc_id", "data", "copies", "first", "ranges", *columns)
