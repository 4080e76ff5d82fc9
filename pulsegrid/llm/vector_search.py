"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced partitions and a small
classifier learns which partitions hold a vector and its neighbours.  Every row is indexed
in its most probable partition; a query goes to the fewest most probable
partitions that held ``target_recall`` of the neighbours of sample rows kept out of the
training, and to more where those hold fewer than ``k`` candidates.  All rows there
are ranked by the exact inner product in double precision.

Rows are worked on in cells of about ``CELL_ROWS``: several small partitions next to each
other, or a part of a large one.  A query comes to a cell once, with the partitions of the
cell that it visits, and leaves it with its ``k`` best there; so the rows that travel are
queries times cells.  Many queries of one cell are dealt to parts of at most about ``CELL_QUERIES``.
The classifier and the sizes of the partitions (at most a sixteenth of ``sample_rows``)
are the only things every task gets.

Cases: vectors that are null, zero, or hold null or non-finite components, and
rows without an id, take no part; so do vectors of another length than the
most frequent one; rows that repeat an id count once, with the smallest vector; equal
scores rank by the smaller id; fewer candidates than ``k`` give all; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise
from .learned_partitions import Router, balanced_partition, neighbour_graph, neighbours_of, train_router

CELL_ROWS = 16384
CELL_QUERIES = 4096
SAMPLE_PER_PARTITION = 16


@dataclass(frozen=True)
class SearchConfig:
    k: int = 20
    sample_rows: int = 8000
    rows_per_partition: int = 800
    target_recall: float = 0.93


def usable_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where(good & F.exists("v", lambda x: x != 0)).groupBy("id").agg(F.min("v").alias("v"))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).select("d")
    return rows.join(F.broadcast(common), F.size("v") == F.col("d"), "left_semi")


def train(sample: np.ndarray, rows: int, cfg: SearchConfig) -> tuple[Router, int]:
    """The router and the number of partitions that a query visits.

    A fifth of the sample is kept out of the training; the neighbours of these rows among
    the others say how many partitions are needed.  As many neighbours count as the sample
    has of a query's ``k`` in the table, at least one, so the distances are those of the table or larger.
    """
    kept_out = len(sample) // 5
    asked, known = sample[:kept_out], sample[kept_out:]
    parts = int(np.clip(rows // cfg.rows_per_partition, 1, max(1, len(known) // SAMPLE_PER_PARTITION)))
    graph = neighbour_graph(known, cfg.k)
    router = train_router(known, graph, balanced_partition(known, graph, parts))
    home = router.probabilities(known).argmax(1)
    near = neighbours_of(asked, known, max(1, round(cfg.k * len(known) / rows)))
    rank = np.argsort(np.argsort(-router.probabilities(asked), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(rank, home[near], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(len(needed) * cfg.target_recall))]) + 1 if len(needed) else parts
    return router, probes


@dataclass(frozen=True)
class Layout:
    """Rows of each partition, the first cell it is in, and over how many cells it is dealt."""

    sizes: np.ndarray
    first: np.ndarray
    cells: np.ndarray


def lay_out(sizes: np.ndarray) -> Layout:
    """Small partitions fill a cell one after another; one of over ``CELL_ROWS`` rows has cells of its own."""
    cells = np.maximum(1, -(-sizes // CELL_ROWS))
    first, at, held = np.zeros(len(sizes), np.int64), 0, 0
    for p, n in enumerate(sizes):
        if held and held + n > CELL_ROWS:
            at, held = at + 1, 0
        first[p] = at
        held += n
        if cells[p] > 1:
            at, held = at + int(cells[p]), 0
    return Layout(sizes, first, cells)


def _index(rows: DataFrame, router: Router) -> DataFrame:
    """(id, v, part): each vector's most probable partition."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(part=router.probabilities(np.stack(batch["v"].to_numpy())).argmax(1).astype(np.int32))

    return rows.mapInPandas(route, "id bigint, v array<double>, part int")


def _ask(rows: DataFrame, router: Router, probes: int, layout: Layout, k: int) -> DataFrame:
    """(id, v, cell, parts): each query once a cell, with the partitions that it visits there."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            if len(batch):
                order = np.argsort(-router.probabilities(np.stack(batch["v"].to_numpy())), axis=1, kind="stable")
                enough = (np.cumsum(layout.sizes[order], axis=1) < k + 1).sum(1) + 1  # its own row may be among them
                for i, v, parts, n in zip(batch["id"], batch["v"], order, np.maximum(enough, probes)):
                    visits: dict[int, list[int]] = {}
                    for p in parts[:n].tolist():
                        for c in range(layout.first[p], layout.first[p] + layout.cells[p]):
                            visits.setdefault(c, []).append(p)
                    out += [(i, v, c, ps) for c, ps in visits.items()]
            yield pd.DataFrame(out, columns=["id", "v", "cell", "parts"])

    return rows.mapInPandas(route, "id bigint, v array<double>, cell bigint, parts array<int>")


def _best_of_cell(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(queries) and len(rows):
        rows = rows.sort_values("part", kind="stable")
        x, ids, part = np.stack(rows["v"].to_numpy()), rows["id"].to_numpy(), rows["part"].to_numpy()
        starts = {p: (np.searchsorted(part, p), np.searchsorted(part, p, "right")) for p in np.unique(part).tolist()}
        for a in range(0, len(queries), 256):
            block = queries.iloc[a : a + 256]
            q, own = np.stack(block["v"].to_numpy()), block["id"].to_numpy()
            s = np.full((len(q), len(x)), -np.inf)
            for p, (lo, hi) in starts.items():
                visit = np.flatnonzero([p in ps for ps in block["parts"]])
                s[visit, lo:hi] = q[visit] @ x[lo:hi].T
            s[own[:, None] == ids[None, :]] = -np.inf
            at = min(k, len(ids)) - 1
            least = np.partition(s, len(ids) - 1 - at, axis=1)[:, len(ids) - 1 - at]
            for i in range(len(q)):
                # the product of whole blocks may differ in the last bits between equal vectors: rank on one formula
                near = np.flatnonzero((s[i] >= least[i] - 1e-9 * (1 + abs(least[i]))) & (s[i] > -np.inf))
                score = (x[near] * q[i]).sum(1)
                top = np.lexsort((ids[near], -score))[:k]
                out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[near][top], "score": score[top]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})


def nearest(table: DataFrame, is_query, cfg: SearchConfig = SearchConfig(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for the rows where ``is_query`` (on column id) holds."""
    spark = table.sparkSession
    rows = materialise(usable_vectors(table, id_col, vector_col), "vectors")
    total = rows.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if total < 2:
        return spark.createDataFrame([], schema)
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(cfg.sample_rows).toPandas()  # bounded by sample_rows
    router, probes = train(np.stack(picked["v"].to_numpy()), total, cfg)

    homes = materialise(_index(rows, router), "index")
    sizes = np.zeros(len(router.b2), np.int64)
    for r in homes.groupBy("part").count().collect():  # a row a partition
        sizes[r["part"]] = r["count"]
    layout = lay_out(sizes)
    asked = materialise(_ask(rows.where(is_query), router, probes, layout, cfg.k), "visits")
    shares = materialise(asked.groupBy("cell").agg(F.ceil(F.count("*") / CELL_QUERIES).alias("shares")), "cells")
    places = spark.createDataFrame(pd.DataFrame({"part": np.arange(len(sizes), dtype=np.int32), "first": layout.first, "cells": layout.cells}))

    indexed = homes.join(F.broadcast(places), "part")  # a row a partition
    indexed = indexed.select("id", "v", "part", (F.col("first") + F.pmod(F.xxhash64("id"), "cells")).alias("cell")).join(shares, "cell")
    candidates = indexed.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "id", "v", "part")
    queries = asked.join(shares, "cell").select("cell", F.pmod(F.xxhash64("id"), "shares").alias("share"), "id", "v", "parts")
    k = cfg.k
    found = (
        queries.groupBy("cell", "share")
        .cogroup(candidates.groupBy("cell", "share"))
        .applyInPandas(lambda q, c: _best_of_cell(q, c, k), "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
