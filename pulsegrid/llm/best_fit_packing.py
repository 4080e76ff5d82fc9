"""Packing documents into sequences of bounded length by exact-complement hashing.

Every text is encoded, an end id is put after it, and documents longer than ``capacity``
are cut into pieces of that length (what is over makes the first piece).  Only the number
of pieces of each length matters to a packing, so it is planned on these counts
(at most ``capacity`` of them, whatever the corpus), and a plan is a list of patterns with
multiplicities:

* the sums of one, two and three available lengths are indexed; from the longest length
  down, a gap that such a sum fills exactly takes that combination, as often as the
  counts allow;
* what has no exact complement goes, longest first, to the fullest sequence that has room
  for it (best fit), all sequences of one pattern at once.

A piece finds its place by its length and its rank among the pieces of that length.  Ranks
come from the number within the task that encoded it and the counts of the tasks
before, so no task ever holds all pieces of a length.

Cases: a null text is empty and has the end id alone; rows that repeat, or share a
doc_id, are packed each; a null doc_id is kept; very long texts are cut whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise, texts


@dataclass(frozen=True)
class PackConfig:
    capacity: int = 1024
    end_id: int = 2


class ComplementIndex:
    """How many ways one, two or three available lengths add up to each sum, kept up to date as lengths run out."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        n = len(counts)  # sums from 0 to the capacity
        one = (counts > 0).astype(np.int64)
        one[0] = 0
        twice, thrice = np.zeros(n, np.int64), np.zeros(n, np.int64)
        twice[: 2 * ((n + 1) // 2) : 2] = one[: (n + 1) // 2]
        third = one[: (n + 2) // 3]
        thrice[: 3 * len(third) : 3] = third
        ordered = np.convolve(one, one)[:n]
        self.single = one
        self.pairs = (ordered + twice) // 2
        self.triples = (np.convolve(ordered, one)[:n] + 3 * np.convolve(twice, one)[:n] + 2 * thrice) // 6

    def take(self, lengths: Counter, times: int) -> None:
        """Takes ``times`` pieces of each length, as often as it is in there."""
        for x, k in lengths.items():
            self.counts[x] -= k * times
            if not self.counts[x] and self.single[x]:
                self.triples[x:] -= self.pairs[: len(self.pairs) - x]
                self.pairs[x:] -= self.single[: len(self.single) - x]
                self.single[x] = 0

    def fitting(self, length: int, most: int = 3) -> Iterator[tuple[int, ...]]:
        """Combinations of ``most`` pieces at most that fill what ``length`` leaves, of fewest pieces first; of pairs, those of which there are most first."""
        gap = len(self.counts) - 1 - length
        if gap == 0:
            yield ()
            return
        if self.single[gap]:
            yield (gap,)
        if most > 1:
            yield from self._pairs(gap, gap)
        if most > 2 and self.triples[gap]:
            for a in range(gap - 2, 0, -1):
                if 3 * a < gap:
                    break
                if self.single[a] and self.pairs[gap - a]:
                    for pair in self._pairs(gap - a, a):
                        yield (a, *pair)

    def _pairs(self, gap: int, most: int) -> Iterator[tuple[int, int]]:
        if self.pairs[gap]:
            a = np.arange((gap + 1) // 2, min(gap - 1, most) + 1)
            there = np.minimum(self.counts[a], self.counts[gap - a])
            for i in np.argsort(-there, kind="stable")[: np.count_nonzero(there)].tolist():
                yield int(a[i]), int(gap - a[i])

    def times(self, lengths: Counter) -> int:
        return min(self.counts[x] // k for x, k in lengths.items())


Pattern = tuple[tuple[int, int], ...]  # (length, how often) in the order of a sequence


def exact_patterns(counts: np.ndarray, most: int = 3) -> list[tuple[Pattern, int]]:
    """Patterns of a piece and ``most`` others at most that fill sequences exactly, with how many sequences have them; takes their pieces off ``counts``."""
    index, made = ComplementIndex(counts), []
    for length in range(len(counts) - 1, 0, -1):
        while counts[length]:
            for combination in index.fitting(length, most):
                lengths = Counter((length, *combination))
                times = int(index.times(lengths))
                if times:
                    made.append((tuple(sorted(lengths.items(), reverse=True)), times))
                    index.take(lengths, times)
                    break
            else:
                break
    return made


def best_fit_patterns(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """Patterns of the pieces by best fit, longest first: each goes where it leaves least room.

    Sequences of one pattern and room are handled together: such a sequence takes as many pieces
    of a length as it has room for before the next one gets any.
    """
    capacity = len(counts) - 1
    by_room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append((pattern, n))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
                fresh = False
            else:
                room, pattern, n, fresh = capacity, (), left, True
            each = room // length
            full = min(n, left // each)
            put(room - each * length, (*pattern, (length, each)), full)
            left -= full * each
            rest = n - full
            if left and left < each and rest:
                put(room - left * length, (*pattern, (length, left)), 1)
                left, rest = 0, rest - 1
            if not fresh:
                put(room, pattern, rest)
    return [x for held in by_room.values() for x in held]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go, by rank: slots in the order of (length, first rank).

    A slot has ``times`` places in each of its sequences, one after another from ``offset``.
    """

    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        begin, end = np.searchsorted(self.length, length), np.searchsorted(self.length, length, "right")
        low, high = begin, end - 1  # the last slot of the length that begins at the rank or before
        while (low < high).any():
            middle = (low + high + 1) // 2
            right = self.first[middle] <= rank
            low, high = np.where(right, middle, low), np.where(right, high, middle - 1)
        inner = rank - self.first[low]
        return self.base[low] + inner // self.times[low], self.offset[low] + inner % self.times[low] * length


def plan_packing(counts: np.ndarray) -> Plan:
    """A packing of ``counts[length]`` pieces of each length into sequences of ``len(counts) - 1``.

    Where complements of three, then of two pieces leave so few short ones that the rest packs
    badly, complements of fewer pieces are planned too; the plan of fewest sequences counts.
    """
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    least = max(-(-int(sizes @ counts) // capacity), int(counts[sizes > capacity / 2].sum()))
    patterns: list[tuple[Pattern, int]] = []
    for most in (3, 2, 1):
        left = np.array(counts, np.int64)
        made = exact_patterns(left, most) + best_fit_patterns(left)
        if not patterns or sum(n for _, n in made) < sum(n for _, n in patterns):
            patterns = made
        if sum(n for _, n in patterns) <= least:
            break
    slots, used, base = [], Counter(), 0
    for pattern, n in patterns:
        offset = 0
        for length, times in pattern:
            slots.append((length, used[length], times, base, offset))
            used[length] += n * times
            offset += length * times
        base += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 5).T
    return Plan(*table, sequences=base)


def encode_pieces(docs: DataFrame, tokenizer_path: str, cfg: PackConfig = PackConfig(), with_ids: bool = False) -> DataFrame:
    """A written table (task, nth, doc_id, piece, start, length, ids_crc32[, ids]); ``nth`` counts the task's pieces of a length from 0."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from ._wordcache import byte_bpe

        bpe, end = byte_bpe(tokenizer_path), np.array([cfg.end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), [0] * (cfg.capacity + 1)
        for batch in batches:
            out = []
            for doc_id, own in zip(batch["doc_id"].astype(object), bpe.encode_all(list(batch["text"]))):
                data, doc_id = own + end, None if pd.isna(doc_id) else int(doc_id)
                n = len(data) // 4
                first = n % cfg.capacity or min(n, cfg.capacity)
                at = 0
                for piece, stop in enumerate(range(first, n + 1, cfg.capacity)):
                    ids, length = data[4 * at : 4 * stop], stop - at
                    out.append((task, seen[length], doc_id, piece, at, length, zlib.crc32(ids), ids if with_ids else None))
                    seen[length] += 1
                    at = stop
            frame = pd.DataFrame(out, columns=["task", "nth", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]).astype({"doc_id": "Int64"})
            yield frame if with_ids else frame.drop(columns="ids")

    schema = "task int, nth bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return materialise(texts(docs).mapInPandas(cut, schema), "pieces")


def pack(pieces: DataFrame, cfg: PackConfig = PackConfig()) -> tuple[DataFrame, Plan]:
    """Adds ``sequence_id`` and ``offset`` to a table of :func:`encode_pieces`, and the plan."""
    by_task = materialise(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(cfg.capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row a length
        counts[r["length"]] = r["n"]
    plan = plan_packing(counts)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranked = pieces.join(by_task.select("length", "task", before.alias("before")), ["length", "task"])
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("task", "nth")], (F.col("before") + F.col("nth")).alias("rank"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("at", place("length", "rank")).select(*[c for c in ranked.columns if c != "rank"], "at.*"), plan


def pack_documents(docs: DataFrame, tokenizer_path: str, cfg: PackConfig = PackConfig()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return pack(encode_pieces(docs, tokenizer_path, cfg), cfg)[0]


def packed_sequences(docs: DataFrame, tokenizer_path: str, cfg: PackConfig = PackConfig()) -> DataFrame:
    """(sequence_id, n_tokens, ids, parts): the ids of each sequence as little-endian 32-bit integers, and whose they are.

    ``parts`` are (offset, doc_id, piece, length), in order; a sequence has ``capacity`` ids at most.
    """
    placed, _ = pack(encode_pieces(docs, tokenizer_path, cfg, with_ids=True), cfg)
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    rows = placed.groupBy("sequence_id").agg(held.alias("held"))
    return rows.select(
        "sequence_id",
        F.aggregate("held", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.unhex(F.concat_ws("", F.transform("held", lambda p: F.hex(p["ids"])))).alias("ids"),
        F.transform("held", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["length"].alias("length"))).alias("parts"),
    )
