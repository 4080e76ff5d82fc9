"""Isolation forest over the z-scores, and scaling of its scores by user.

A tree is grown from ``tree_rows`` rows drawn by hash (one group of that many rows
a tree), so growing is one grouped pass however large the table is.  Draws and splits are hashes in
whole numbers, so SQL can grow the same forest.  The forest is a
table of nodes; scoring sends it to the tasks (``trees`` times at most
2 * ``tree_rows`` nodes, a bound by configuration).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.config import PipelineConfig
from pulsegrid.functions.columns import clip
from pulsegrid.functions.quantiles import grouped_quantiles
from pulsegrid.sources.tables import settle

FOREST_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, rows int, depth int, features array<string>"


def path_length(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n keys."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


#: Features are compared in units of a billionth, so that a tree doesn't hang on the last bits of a z-score.
UNIT = 1_000_000_000
#: Rows are drawn by a linear hash modulo this prime.
PRIME = 2_147_483_647


def hashed(*parts: object) -> int:
    """A number of 60 bits from the md5 of the parts."""
    return int(md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def grow_tree(x: np.ndarray, seed: int, tree: int) -> list[tuple[int, int, float, int, int, int, int]]:
    """Nodes (number, feature or -1, threshold, left, right, rows, depth) of one isolation tree on whole-number features.

    The root is 1 and the children of a node n are 2n and 2n + 1.  The feature of a split, among those that differ,
    and its place come from hashes of the node's number, so a tree is a function of its rows.
    """
    limit = math.ceil(math.log2(max(2, len(x))))
    nodes, stack = [], [(1, x, 0)]
    while stack:
        at, rows, depth = stack.pop()
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(x.shape[1], np.int64),) * 2
        splits = np.flatnonzero(high > low)
        if depth >= limit or not len(splits):
            nodes.append((at, -1, 0.0, -1, -1, len(rows), depth))
            continue
        f = int(splits[hashed(seed, tree, at, "feature") % len(splits)])
        cut = int(low[f]) + hashed(seed, tree, at, "place") % int(high[f] - low[f])
        nodes.append((at, f, cut / UNIT, 2 * at, 2 * at + 1, len(rows), depth))
        goes = rows[:, f] <= cut
        stack += [(2 * at, rows[goes], depth + 1), (2 * at + 1, rows[~goes], depth + 1)]
    return nodes


def in_units(x: np.ndarray) -> np.ndarray:
    return np.floor(x * UNIT + 0.5)


def usable_features(rows: DataFrame, z: list[str], cfg: PipelineConfig) -> list[str]:
    """Columns that are null in less than ``feature_null_share`` of the rows; all, if there are none."""
    share = rows.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in z]).first()
    return [c for c in z if share[c] is not None and share[c] < cfg.feature_null_share] or z


def entries(chosen: DataFrame, n: int, cfg: PipelineConfig) -> DataFrame:
    """(tree, h, row, and the columns of ``chosen``): the trees that each of the n rows may enter, about four times as many rows a tree as it takes.

    A row names its few trees itself, so no more rows are made than enter one.
    """
    keep = min(1.0, 4 * cfg.tree_rows / max(1, n))
    row = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(cfg.seed), "uuid", F.date_format("date", "yyyy-MM-dd"))), 1, 15), 16, 10).cast("long")

    def draw(tree: Column) -> Column:
        tree = tree.cast("long")
        factor, shift = 1 + (tree * 2_654_435_761 + cfg.seed) % (PRIME - 1), (tree * 2_246_822_519 + cfg.seed) % PRIME
        return (F.col("row") % PRIME * factor + shift) % PRIME

    enters = F.filter(F.sequence(F.lit(0), F.lit(cfg.trees - 1)), lambda t: draw(t) < math.ceil(keep * PRIME))
    return chosen.withColumn("row", row).select(F.explode(enters).alias("tree"), "*").withColumn("h", draw(F.col("tree")))


def train_forest(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The node table of a forest, grown on good days that baselines learn from, else on scored days, else on all."""
    z = [c for c in rows.columns if c.endswith("_z")]
    use = usable_features(rows, z, cfg)
    counts = rows.agg(F.count_if(F.col("scored") & F.col("baseline_fit")).alias("fit"), F.count_if("scored").alias("scored"), F.count("*").alias("all")).first()
    chosen = rows.where("scored and baseline_fit") if counts["fit"] else rows.where("scored") if counts["scored"] else rows
    n = counts["fit"] or counts["scored"] or counts["all"]
    chosen = chosen.select("uuid", "date", F.array(*[F.coalesce(c, F.lit(0.0)) for c in use]).alias("x"))
    drawn = entries(chosen, n, cfg)
    drawn = drawn.withColumn("r", F.row_number().over(Window.partitionBy("tree").orderBy("h", "row", "uuid", "date"))).where(F.col("r") <= cfg.tree_rows)
    seed, names = cfg.seed, use

    def grow(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = in_units(np.stack(part["x"].to_numpy())).astype(np.int64)
        out = pd.DataFrame(grow_tree(x, seed, int(key[0])), columns=["node", "feature", "threshold", "left", "right", "rows", "depth"])
        return out.assign(tree=int(key[0]), features=[names] * len(out))[["tree", "node", "feature", "threshold", "left", "right", "rows", "depth", "features"]]

    return drawn.groupBy("tree").applyInPandas(grow, FOREST_SCHEMA)


def forest_scores(rows: DataFrame, forest: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds ``anomaly_score_raw`` (0 to 1, higher: easier to isolate) on scored days, with the features the forest was grown on."""
    table = forest.toPandas()  # bounded by trees and tree_rows
    if table.empty:
        return rows.withColumn("anomaly_score_raw", F.lit(None).cast("double"))
    names = list(table["features"].iloc[0])
    trees = []
    for _, t in table.groupby("tree"):
        by_number = np.zeros((int(t["node"].max()) + 1, 6))
        by_number[t["node"]] = t[["feature", "threshold", "left", "right", "rows", "depth"]].to_numpy()
        by_number[:, 1] = in_units(by_number[:, 1])
        trees.append(by_number)
    norm = float(path_length(max(t[1][4] for t in trees)))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = in_units(np.stack(part.to_numpy())) if len(part) else np.empty((0, len(names)))
            depth = np.zeros(len(x))
            for t in trees:
                at = np.ones(len(x), np.int64)
                while True:
                    inner = np.flatnonzero(t[at, 0] >= 0)
                    if not len(inner):
                        break
                    node = at[inner]
                    goes = x[inner, t[node, 0].astype(np.int64)] <= t[node, 1]
                    at[inner] = np.where(goes, t[node, 2], t[node, 3]).astype(np.int64)
                depth += t[at, 5] + path_length(t[at, 4])
            yield pd.Series(np.exp2(-depth / len(trees) / max(norm, 1e-12)))

    raw = score(F.array(*[F.coalesce(c, F.lit(0.0)) for c in names]))
    return rows.withColumn("anomaly_score_raw", F.when(F.col("scored"), raw))


def mean_abs_z(rows: DataFrame) -> DataFrame:
    """A raw anomaly score without a model: the mean absolute z-score, a missing one as zero."""
    z = [c for c in rows.columns if c.endswith("_z")]
    total = sum((F.abs(F.coalesce(c, F.lit(0.0))) for c in z), F.lit(0.0))
    return rows.withColumn("anomaly_score_raw", F.when(F.col("scored"), total / len(z)))


def scale_by_user(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Adds ``anomaly_score`` between the user's own outer quantiles, and ``anomaly_flag`` from the upper one on."""
    if cfg.segment_rows is None:
        low, high = (F.percentile("anomaly_score_raw", q).over(Window.partitionBy("uuid")) for q in cfg.scale_quantiles)
        rows = rows.select("*", low.alias("_low"), high.alias("_high"))
    else:  # no task holds a user
        rows = settle(rows, "raw")
        found = grouped_quantiles(rows, ["uuid"], F.col("anomaly_score_raw"), cfg.scale_quantiles)
        found = found.select("uuid", F.get("q", F.lit(0)).alias("_low"), F.get("q", F.lit(1)).alias("_high"))
        rows = rows.join(found, "uuid", "left")
    raw = F.col("anomaly_score_raw")
    score = F.coalesce(clip(F.try_divide(raw - F.col("_low"), F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))), 0.0, 1.0), F.lit(0.0))
    return rows.withColumns({"anomaly_score": F.when(raw.isNotNull(), score), "anomaly_flag": raw >= F.col("_high")}).drop("_low", "_high")
