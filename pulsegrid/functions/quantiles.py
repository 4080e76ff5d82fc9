"""Exact quantiles of whole columns and of groups without gathering a column or a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.tables import settle


def _ranked(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, value, n, total, end): how often each different value occurs, and how many of its group's values end with it.

    Equal values are counted first and dealt by range, so a task holds one range of the
    different values, of however many groups; a small table of the ranges' sizes turns places within a range into ranks.
    """
    counted = values.where("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n"))
    dealt = settle(counted.repartitionByRange(*keys, "value").withColumn("range", F.spark_partition_id()), "quantiles")
    of_group = Window.partitionBy(*keys)
    ranges = dealt.groupBy(*keys, "range").agg(F.sum("n").alias("size"))  # groups times their ranges
    ranges = ranges.select(
        *keys,
        "range",
        F.coalesce(F.sum("size").over(of_group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("size").over(of_group).alias("total"),
    )
    within = Window.partitionBy(*keys, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(ranges, [*keys, "range"]).withColumn("end", F.col("before") + F.sum("n").over(within))


def _value_at(rank: Column, here: Column | None = None) -> Column:
    found = (F.col("end") - F.col("n") <= rank) & (rank < F.col("end"))
    return F.max(F.when(found if here is None else here & found, F.col("value")))


def _between(q: float, n: Column, low: Column, high: Column) -> Column:
    place = F.lit(q) * (n - 1)
    return low + (high - low) * (place - F.floor(place))


def exact_quantiles(rows: DataFrame, columns: Mapping[str, Column], quantiles: Sequence[float]) -> DataFrame:
    """One row: for each name the count ``<name>_n`` of its values and the array ``<name>_q`` of their quantiles.

    Values are interpolated between the two nearest ranks; nulls don't count; a column
    without values has a count of 0 and null quantiles.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), v.cast("double").alias("value")) for c, v in columns.items()])
    ranked = _ranked(rows.select(F.inline(pairs)), ["name"])
    made = []
    for c in columns:
        mine = F.col("name") == c
        made.append(F.coalesce(F.max(F.when(mine, F.col("total"))), F.lit(0)).alias(f"{c}_n"))
        for i, q in enumerate(quantiles):
            place = F.lit(q) * (F.col("total") - 1)
            made += [_value_at(F.floor(place), mine).alias(f"{c}_{i}_low"), _value_at(F.ceil(place), mine).alias(f"{c}_{i}_high")]
    found = ranked.agg(*made)

    def all_of(c: str) -> Column:
        return F.array(*[_between(q, F.col(f"{c}_n"), F.col(f"{c}_{i}_low"), F.col(f"{c}_{i}_high")) for i, q in enumerate(quantiles)])

    return found.select(*[f"{c}_n" for c in columns], *[all_of(c).alias(f"{c}_q") for c in columns])


def grouped_quantiles(rows: DataFrame, keys: Sequence[str], value: Column, quantiles: Sequence[float]) -> DataFrame:
    """(keys, n, q): count and quantiles of each group's values, as :func:`exact_quantiles` has them of a column.

    Groups without a value, and rows with a null key, have no row.
    """
    ranked = _ranked(rows.select(*keys, value.cast("double").alias("value")), keys)
    places = [F.lit(q) * (F.col("total") - 1) for q in quantiles]
    ends = [x for i, p in enumerate(places) for x in (_value_at(F.floor(p)).alias(f"low_{i}"), _value_at(F.ceil(p)).alias(f"high_{i}"))]
    found = ranked.groupBy(*keys).agg(F.max("total").alias("n"), *ends)
    return found.select(*keys, "n", F.array(*[_between(q, F.col("n"), F.col(f"low_{i}"), F.col(f"high_{i}")) for i, q in enumerate(quantiles)]).alias("q"))
