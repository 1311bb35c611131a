"""Running sums and neighbours along the tree's preorder without a global window.

A window without partitions sends all rows to one task. Preorder keys are 63-bit numbers, so rows are grouped by their
upper 42 bits and these groups by their upper 21: sums of whole groups are added up first, and only rows of one group
meet in a window. The one window without partitions sees at most 2^21 sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.morton import shift_right


def running_sums(df: DataFrame, key: str, order: list[str], values: dict[str, Column]) -> DataFrame:
    """Adds under each name the sum of its value over all rows before this one, in order of key and order, all in one pass.

    Every key must be >= 0.
    """
    fine, coarse = "__fine", "__coarse"
    rows = df.withColumns({**{f"__value_{n}": v.cast("long") for n, v in values.items()}, fine: shift_right(F.col(key), 21), coarse: shift_right(F.col(key), 42)})
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    upto = lambda c, w: F.coalesce(F.sum(c).over(before(w)), F.lit(0))
    fines = rows.groupBy(coarse, fine).agg(*(F.sum(f"__value_{n}").alias(f"__s_{n}") for n in values))
    coarses = fines.groupBy(coarse).agg(*(F.sum(f"__s_{n}").alias(f"__t_{n}") for n in values))
    coarses = coarses.select(coarse, *(upto(f"__t_{n}", W.orderBy(coarse)).alias(f"__base_{n}") for n in values))
    starts = [(F.col(f"__base_{n}") + upto(f"__s_{n}", W.partitionBy(coarse).orderBy(fine))).alias(f"__start_{n}") for n in values]
    fines = fines.join(coarses, coarse).select(fine, *starts)
    inner = W.partitionBy(fine).orderBy(key, *order)
    out = rows.join(fines, fine).withColumns({n: (F.col(f"__start_{n}") + upto(f"__value_{n}", inner)).cast("long") for n in values})
    return out.drop(fine, coarse, *(f"__{kind}_{n}" for kind in ("value", "start") for n in values))


def running_sum(df: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of value over all rows before this one, in order of key and order; every key must be >= 0."""
    return running_sums(df, key, order, {name: value})


def previous_max(df: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the greatest value of all rows before this one; null for the first."""
    fine, coarse = "__fine", "__coarse"
    rows = df.withColumns({"__value": value.cast("long"), fine: shift_right(F.col(key), 21), coarse: shift_right(F.col(key), 42)})
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    fines = rows.groupBy(coarse, fine).agg(F.max("__value").alias("__s"))
    coarses = fines.groupBy(coarse).agg(F.max("__s").alias("__t"))
    coarses = coarses.select(coarse, F.max("__t").over(before(W.orderBy(coarse))).alias("__base"))
    fines = fines.join(coarses, coarse).select(fine, F.greatest("__base", F.max("__s").over(before(W.partitionBy(coarse).orderBy(fine)))).alias("__start"))
    inner = before(W.partitionBy(fine).orderBy(key, *order))
    out = rows.join(fines, fine).withColumn(name, F.greatest("__start", F.max("__value").over(inner)))
    return out.drop("__value", fine, coarse, "__start")
