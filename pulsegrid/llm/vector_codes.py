"""Product codes of vectors by delta-maintained Lloyd rounds.

Components become integers ``floor(scale * x)`` and a vector is cut into equal
consecutive parts, each with a codebook of its own.  A round assigns every part to the
nearest entry (squared distance, ties to the lower number) and replaces an entry by the
componentwise floor of its parts' mean.  All arithmetic is on integers, so the result is
the same however the rows are dealt.

The assignments of the round before are kept in a table, and so are, on the driver, the
sum and the number of each entry's parts (as many integers as the codebooks have).  A
round rewrites the table in place of the one before without a shuffle; only parts whose
assignment changed are sent on, added to the new entry and taken from the old one, and
these contributions are summed up in each task before they travel.

Cases: rows whose vector is null or holds null or non-finite components take no
part, nor do those of another length than the most frequent one that the parts divide (the
shorter among equals), nor empty vectors; integer components end at 2^27 on either side; rows
without an id are coded too and come last where entries are chosen; rows that repeat count each;
fewer rows than entries give codebooks of that many; equal labels (nulls together) share
``label_error``, and a table without a label column has one label; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, materialise
from ._vectors import finite, integers, squared_distances

#: Rows whose distances to all entries are held at once.
BLOCK = 2048


@dataclass(frozen=True)
class CodeConfig:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


@dataclass
class Codebooks:
    """``entries[part, number]`` are the entries; ``sums`` and ``counts`` what their parts add up to."""

    entries: np.ndarray
    sums: np.ndarray
    counts: np.ndarray

    @classmethod
    def starting(cls, vectors: np.ndarray, parts: int) -> Codebooks:
        """The parts of the given vectors as entries."""
        entries = vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2).astype(np.int64)
        return cls(entries.copy(), np.zeros_like(entries), np.zeros(entries.shape[:2], np.int64))

    def add(self, part: int, entry: int, count: int, sums: list[int]) -> None:
        self.counts[part, entry] += count
        self.sums[part, entry] += np.array(sums, np.int64)

    def settle(self) -> None:
        """Each entry that has parts becomes their mean, rounded down."""
        used = self.counts > 0
        self.entries[used] = self.sums[used] // self.counts[used][:, None]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest entry of each part, squared distance over all parts) of integer vectors."""
        parts, _, width = self.entries.shape
        codes, error = np.empty((len(x), parts), np.int16), np.zeros(len(x), np.int64)
        for a in range(0, len(x), BLOCK):
            b = slice(a, a + BLOCK)
            for p in range(parts):
                d = squared_distances(x[b, p * width : (p + 1) * width], self.entries[p])
                codes[b, p] = d.argmin(1)
                error[b] += d[np.arange(len(d)), codes[b, p]]
        return codes, error

    def digest(self) -> str:
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_vectors(table: DataFrame, cfg: CodeConfig, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v array<int>) of the rows that take part."""
    label = F.col(f"`{label_col}`") if label_col in table.columns else F.lit(None).cast("int")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), F.col(f"`{vector_col}`").alias("v"))
    rows = rows.where(finite(F.col("v")))
    fits = rows.where((F.size("v") > 0) & (F.size("v") % cfg.parts == 0))
    common = fits.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()  # one row
    return rows.where(F.size("v") == (common["d"] if common else -1)).withColumn("v", integers(F.col("v"), cfg.scale))


_STATE = "vec_id bigint, {label}, v array<int>, codes array<smallint>, was array<smallint>"


def _assigned(state: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """The rows with the codes of this round, and those of the round before as ``was``."""
    first = "codes" not in state.columns

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                codes, _ = books.assign(np.stack(batch["v"].to_numpy()))
                was = None if first else batch["codes"].to_numpy()
                yield batch[["vec_id", "label", "v"]].assign(codes=list(codes), was=was)

    return state.mapInPandas(work, _STATE.format(label=label))


def _contributions(state: DataFrame, parts: int, width: int) -> DataFrame:
    """(part, entry, count, sums) that the changed parts add to their new entries and take from their old ones."""
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    rows = state.where("was is null or was != codes").select(each.alias("part"), "v", "codes", "was")
    rows = rows.select("part", F.slice("v", F.col("part") * width + 1, F.lit(width)).alias("x"), F.get("codes", "part").alias("new"), F.get("was", "part").alias("old"))
    rows = rows.where("old is null or old != new")
    signed = F.array(F.struct(F.col("new").alias("entry"), F.lit(1).alias("sign")), F.struct(F.col("old").alias("entry"), F.lit(-1).alias("sign")))
    moves = rows.select("part", "x", F.inline(signed)).where("entry is not null")
    sums = [F.sum(F.col("sign") * F.get("x", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(width)]
    return moves.groupBy("part", "entry").agg(F.sum("sign").alias("count"), *sums)


def train_codebooks(rows: DataFrame, cfg: CodeConfig = CodeConfig()) -> tuple[Codebooks, DataFrame] | None:
    """The codebooks after all rounds, and the table of the last round's assignments; None without rows.

    ``rows`` is a table of :func:`integer_vectors`.
    """
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(cfg.entries).select("v").collect()  # at most ``entries`` rows
    if not start:
        return None
    books = Codebooks.starting(np.array([r["v"] for r in start]), cfg.parts)
    label = f"label {rows.schema['label'].dataType.simpleString()}"
    state = rows
    for _ in range(cfg.rounds):
        before, state = state, materialise(_assigned(state, books, label), "codes")
        if before is not rows:
            discard(before)
        for r in _contributions(state, cfg.parts, books.entries.shape[2]).collect():  # at most a row an entry
            books.add(r["part"], r["entry"], r["count"], list(r[3:]))
        books.settle()
    return books, state


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, codes, error) of a table of :func:`integer_vectors`: the nearest entry of each part."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                codes, error = books.assign(np.stack(batch["v"].to_numpy()))
                yield batch[["vec_id", "label"]].assign(codes=list(codes), error=error)

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInPandas(work, f"vec_id bigint, label {label}, codes array<smallint>, error bigint")


def decode(coded: DataFrame, books: Codebooks, cfg: CodeConfig = CodeConfig()) -> DataFrame:
    """Adds ``approximate``, the vector that the codes stand for (the middle of each integer's range)."""

    @F.pandas_udf("array<double>")
    def vectors(codes: pd.Series) -> pd.Series:
        return pd.Series([((np.concatenate([book[k] for book, k in zip(books.entries, c)]) + 0.5) / cfg.scale) for c in codes], dtype=object)

    return coded.withColumn("approximate", vectors("codes"))


def compress(table: DataFrame, cfg: CodeConfig = CodeConfig(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, codes, error) of every row that takes part, and the codebooks."""
    rows = materialise(integer_vectors(table, cfg, id_col, vector_col, label_col), "integers")
    trained = train_codebooks(rows, cfg)
    if trained is None:
        return rows.select("vec_id", "label", F.array().cast("array<smallint>").alias("codes"), F.lit(0).cast("long").alias("error")), None
    books, state = trained
    return encode(state, books), books


def code_table(table: DataFrame, cfg: CodeConfig = CodeConfig(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as two hex digits a part."""
    coded, books = compress(table, cfg, id_col, vector_col, label_col)
    coded = materialise(coded, "coded")
    of_label = materialise(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "label-errors")
    code = F.concat_ws("", F.transform("codes", lambda k: F.lower(F.lpad(F.hex(k.cast("long")), 2, "0"))))
    digest = F.lit(books.digest() if books else None).cast("string")
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))
