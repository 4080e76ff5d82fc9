"""Centroid clustering with Yinyang bounds.

Components become integers ``floor(scale * x)``; the starting centroids are the vectors
with the smallest hash of their id.  A round assigns every vector to the nearest centroid
(squared distance, ties to the smaller number) and replaces a centroid that has vectors by
their componentwise mean, rounded down.

The centroids are put into a few groups once.  A vector keeps an upper bound of the distance to its
own centroid and one lower bound a group of the distances to the group's other
centroids; both follow the centroids' moves.  Where the smallest lower bound is above the
upper one, the assignment stands (the global filter, tried again with the exact distance
to the own centroid); else only groups whose bound is below are looked at, and in these only centroids
that their own move may have brought near are measured exactly.  Bounds are compared with a margin far above their
rounding, and distances are compared as integers, so the result is that of measuring everything.

A round is one pass over a table that holds vector, assignment and bounds, written in place
of the one before, and sums by cluster that are partly aggregated before their shuffle.
Centroids, groups and sums are as many as ``clusters``, whatever the number of vectors.

Cases: rows whose vector is null, has another length than ``dims``, or holds null or
non-finite components take no part; integer components end at 2^27 on either side; a row
without an id is clustered but comes last among the starting centroids; rows that repeat
count each; fewer vectors than ``clusters`` give as many clusters; an empty table gives an empty result; other columns are ignored.
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

#: Relative margin between bounds, far above the rounding of a few additions.
MARGIN = 1e-9
#: Rows whose distances to all centroids are held at once.
BLOCK = 2048


@dataclass(frozen=True)
class ClusterConfig:
    clusters: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    seed: str = "1"
    centroids_per_group: int = 4


def group_centroids(centroids: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """A group for each centroid, by a few Lloyd rounds from evenly spaced ones; numbers without gaps."""
    x = centroids.astype(np.float64)
    middles = x[:: max(1, len(x) // groups)][:groups].copy()
    for _ in range(rounds):
        own = ((x[:, None] - middles[None]) ** 2).sum(2).argmin(1)
        for g in np.unique(own):
            middles[g] = x[own == g].mean(0)
    return np.unique(own, return_inverse=True)[1]


@dataclass
class Bounds:
    """Assignment, upper bound to the own centroid, lower bounds by group, of some vectors."""

    cluster: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def measure_all(x: np.ndarray, centroids: np.ndarray, groups: np.ndarray) -> Bounds:
    """The first assignment, with bounds that are exact."""
    out = Bounds(np.empty(len(x), np.int32), np.empty(len(x)), np.empty((len(x), groups.max() + 1)))
    for a in range(0, len(x), BLOCK):
        b = slice(a, a + BLOCK)
        d = squared_distances(x[b], centroids)
        out.cluster[b] = own = d.argmin(1)
        far = np.sqrt(d.astype(np.float64))
        row = np.arange(len(d))
        out.upper[b] = far[row, own]
        far[row, own] = np.inf
        for g in range(groups.max() + 1):
            out.lower[b, g] = far[:, groups == g].min(1)
    return out


def _above(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    return lower * (1 - MARGIN) > upper * (1 + MARGIN)


def own_distances(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to its own centroid."""
    return ((x.astype(np.int64) - centroids[cluster]) ** 2).sum(1)


def measure_near(x: np.ndarray, was: Bounds, centroids: np.ndarray, groups: np.ndarray, moved: np.ndarray) -> tuple[Bounds, int]:
    """The assignment after the centroids moved by ``moved``, and how many distances were measured."""
    n_groups = groups.max() + 1
    of_group = np.array([moved[groups == g].max() for g in range(n_groups)])
    cluster, upper = was.cluster.copy(), was.upper + moved[was.cluster]
    lower = was.lower - of_group
    open_rows = np.flatnonzero(~_above(lower.min(1), upper))
    exact = own_distances(x[open_rows], centroids, cluster[open_rows])
    upper[open_rows] = np.sqrt(exact.astype(np.float64))
    measured = len(open_rows)
    still = ~_above(lower[open_rows].min(1), upper[open_rows])
    open_rows, exact = open_rows[still], exact[still]
    for a in range(0, len(open_rows), BLOCK):
        rows, best = open_rows[a : a + BLOCK], exact[a : a + BLOCK].copy()
        old = cluster[rows]
        own, own_far = old.copy(), upper[rows].copy()
        bound = np.full((len(rows), len(centroids)), np.inf)  # of the distance to each centroid, where its group is looked at
        bound[np.arange(len(rows)), old] = own_far
        look = ~_above(lower[rows], own_far[:, None])
        for c, g in enumerate(groups):
            other = look[:, g] & (old != c)
            bound[other, c] = was.lower[rows[other], g] - moved[c]
            near = np.flatnonzero(other & ~_above(bound[:, c], own_far))
            if len(near):
                d = squared_distances(x[rows[near]], centroids[c : c + 1])[:, 0]
                measured += len(near)
                bound[near, c] = np.sqrt(d.astype(np.float64))
                wins = (d < best[near]) | (d == best[near]) & (c < own[near])
                own[near[wins]], best[near[wins]] = c, d[wins]
        cluster[rows], upper[rows] = own, np.sqrt(best.astype(np.float64))
        left = np.where(old != own)[0]
        other_far = bound.copy()
        other_far[np.arange(len(rows)), own] = np.inf
        for g in range(n_groups):
            at = rows[look[:, g]]
            lower[at, g] = other_far[look[:, g]][:, groups == g].min(1)
        g_old = groups[old[left]]  # the centroid that a vector left counts for its group from now on
        lower[rows[left], g_old] = np.minimum(lower[rows[left], g_old], own_far[left])
    return Bounds(cluster, upper, lower), measured


def integer_vectors(table: DataFrame, cfg: ClusterConfig, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<int>) of the rows that take part."""
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    return rows.where(finite(F.col("v")) & (F.size("v") == cfg.dims)).withColumn("v", integers(F.col("v"), cfg.scale))


_STATE = "vec_id bigint, v array<int>, cluster int, upper double, lower array<double>"


def _pass(state: DataFrame, centroids: np.ndarray, groups: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy())
                if moved is None:
                    now = measure_all(x, centroids, groups)
                else:
                    was = Bounds(batch["cluster"].to_numpy(), batch["upper"].to_numpy(), np.stack(batch["lower"].to_numpy()))
                    now, _ = measure_near(x, was, centroids, groups, moved)
                yield batch[["vec_id", "v"]].assign(cluster=now.cluster, upper=now.upper, lower=list(now.lower))

    return state.mapInPandas(work, _STATE)


def cluster_vectors(table: DataFrame, cfg: ClusterConfig = ClusterConfig(), id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, cluster, distance) of every row that takes part, and the final centroids."""
    rows = materialise(integer_vectors(table, cfg, id_col, vector_col), "integers")
    key = F.sha2(F.concat(F.lit(f"{cfg.seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = rows.orderBy(key.asc_nulls_last(), "v").limit(cfg.clusters).select("v").collect()  # at most ``clusters`` rows
    if not start:
        return rows.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.empty((0, cfg.dims), np.int64)
    centroids = np.array([r["v"] for r in start], np.int64)
    groups = group_centroids(centroids, max(1, len(centroids) // cfg.centroids_per_group))
    state, moved = rows, None
    for turn in range(cfg.rounds + 1):
        before, state = state, materialise(_pass(state, centroids, groups, moved), "clusters")
        if before is not rows:
            discard(before)
        if turn < cfg.rounds:
            sums = [F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(cfg.dims)]
            new = centroids.copy()
            for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # a row a cluster
                new[r["cluster"]] = np.array(r[2:], np.int64) // r["n"]
            moved = np.sqrt(((new - centroids) ** 2).sum(1).astype(np.float64))
            centroids = new

    @F.pandas_udf("bigint")
    def distance(v: pd.Series, cluster: pd.Series) -> pd.Series:
        return pd.Series(own_distances(np.stack(v.to_numpy()), centroids, cluster.to_numpy()) if len(v) else np.empty(0, np.int64))

    return state.select("vec_id", "v", "cluster", distance("v", "cluster").alias("distance")), centroids


def cluster_table(table: DataFrame, cfg: ClusterConfig = ClusterConfig(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every row that takes part."""
    found, centroids = cluster_vectors(table, cfg, id_col, vector_col)
    found = materialise(found.select("vec_id", "cluster", "distance"), "clustered")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a cluster
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(k, inertia.get(k, 0), sum(inertia.values()), d) for k, d in enumerate(digests)]
    known = found.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
