"""Connected components of an edge table by alternating star contractions.

Every step is a join and an aggregation; no component, link list or label table
is ever gathered in one task or on the driver.  Lineage is cut by
``checkpoint()`` in the shared folder after each round, and what the round before
held in the driver is given up then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import release_shuffles, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def component_labels(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node of ``edges(u, v)`` but the least of each component.

    ``label`` is the smallest node reachable.  ``known`` has labels of an earlier
    call, whose edges count as well.  Self loops and nulls are ignored; no edges
    give an empty table.
    """
    spark = edges.sparkSession
    scratch_path(spark, "components")  # makes sure that a checkpoint folder is set

    def signature(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h")).first()
        return row["n"], row["h"]

    current = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u != v")
    if known is not None:
        current = current.union(known.select("node", "label"))
    current = current.distinct().checkpoint()
    seen = signature(current)
    while seen[0]:
        current = _small_star(_large_star(current)).checkpoint()
        now = signature(current)
        if now == seen:
            break
        seen = now
        release_shuffles(spark)
    return current.select(F.col("u").alias("node"), F.col("v").alias("label"))
