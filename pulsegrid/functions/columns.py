"""Column expressions that Spark has no single function for; nulls stay nulls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    """Between two limits; a null isn't replaced by a limit."""
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))


def present(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def row_quantile(values: Column, q: float) -> Column:
    """Quantile of an array's non-null values with linear interpolation; null if there are none."""
    v = F.array_sort(present(values))
    at = (F.size(v) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(v, low), F.get(v, F.least(low + 1, F.size(v) - 1))
    return F.when(F.size(v) > 0, a + (at - low) * (b - a))


def trim_mean(values: Column, share: float = 0.8) -> Column:
    """Mean of the lowest share of an array's non-null values, of one at least."""
    v = F.array_sort(present(values))
    k = F.greatest(F.lit(1), F.floor(F.size(v) * F.lit(share)).cast("int"))
    total = F.aggregate(F.slice(v, 1, k), F.lit(0.0), lambda t, x: t + x)
    return F.when(F.size(v) > 0, total / k)


def entropy(counts: Column, total: Column) -> Column:
    """Natural entropy of an array of counts, summed over the counts and not over their shares, as SQL has it: equal counts give its bits."""
    terms = F.transform(counts, lambda c: F.when(c > 0, c * F.log(c)).otherwise(F.lit(0.0)))
    return F.when(total > 0, F.log(total) - F.aggregate(terms, F.lit(0.0), lambda t, x: t + x) / total)


def top_by_abs(names_values: Iterable[tuple[str, Column]]) -> Column:
    """(name, value) struct of the column with the largest absolute value, the first among equals; null if all are null."""
    entries = [
        F.when(v.isNotNull(), F.struct(F.abs(v).alias("size"), F.lit(-i).alias("at"), F.lit(n).alias("name"), v.alias("value")))
        for i, (n, v) in enumerate(names_values)
    ]
    return F.array_max(F.array(*entries))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, without negative zeros."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
