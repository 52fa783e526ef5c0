"""Ordered window operators that also hold for a key with a huge number of rows.

A plain ordered window sorts all rows of a key in one task. Where a key is known to be short (one row per item and
month) that is right, and it is what happens without ``slice_by``. With ``slice_by``, a column expression that never
decreases along the order (its month, its day), the key is cut into slices: each slice is a window of its own, and
one small row per slice (its total, its count, its last rows) carries the state over to the next slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import ratio
from millrace.operators.aggregates import with_group_stat
from millrace.operators.joins import match


def _order(order: Sequence[str], reverse: bool = False) -> list[Column]:
    return [F.desc(o) if reverse else F.asc(o) for o in order]


def _shift(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, n: int, slice_by: Column | None,
    reverse: bool,
) -> DataFrame:
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, reverse))
        return df.withColumn(name, F.lag(value, n).over(w))
    cut = df.withColumn("_s", slice_by)
    parts = [*keys, "_s"]
    inside = Window.partitionBy(*parts).orderBy(*_order(order, reverse))
    # The last n rows of each slice, in order, are all that later slices can need.
    if n == 1:
        pick = F.min_by if reverse else F.max_by
        tail = F.array(F.struct(pick(F.struct(F.col(value).alias("v")), F.struct(*order))["v"].alias("v")))
        tails = cut.groupBy(*parts).agg(tail.alias("_tail"))
    else:
        backwards = F.row_number().over(Window.partitionBy(*parts).orderBy(*_order(order, not reverse)))
        last = cut.select(*parts, F.col(value).alias("_v"), backwards.alias("_b")).filter(F.col("_b") <= n)
        listed = F.array_sort(F.collect_list(F.struct((-F.col("_b")).alias("p"), F.col("_v").alias("v"))))
        tails = last.groupBy(*parts).agg(F.transform(listed, lambda t: F.struct(t["v"].alias("v"))).alias("_tail"))
    slices = Window.partitionBy(*keys).orderBy(F.desc("_s") if reverse else F.asc("_s")).rowsBetween(-n, -1)
    carried = tails.select(*parts, F.flatten(F.collect_list("_tail").over(slices)).alias("_carry"))
    position = F.row_number().over(inside)
    ahead = F.get(F.col("_carry"), F.size("_carry") - n - 1 + F.col("_p").cast("int"))["v"]
    return (
        match(cut.withColumns({"_p": position, "_in": F.lag(value, n).over(inside)}), carried, parts)
        .withColumn(name, F.when(F.col("_p") > n, F.col("_in")).otherwise(ahead))
        .drop("_s", "_p", "_in", "_carry")
    )


def with_lag(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, n: int = 1,
    slice_by: Column | None = None,
) -> DataFrame:
    """Value of the n-th row before, per key."""
    return _shift(df, keys, order, value, name, n, slice_by, reverse=False)


def with_lead(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, n: int = 1,
    slice_by: Column | None = None,
) -> DataFrame:
    """Value of the n-th row after, per key."""
    return _shift(df, keys, order, value, name, n, slice_by, reverse=True)


def growth(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "growth",
    slice_by: Column | None = None,
) -> DataFrame:
    """``(x - next x) / x`` along the order; null on the last row and where x is 0."""
    out = with_lead(df, keys, order, value, "_next", slice_by=slice_by)
    return out.withColumn(name, ratio(F.col(value) - F.col("_next"), F.col(value))).drop("_next")


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, slice_by: Column | None = None
) -> DataFrame:
    """Sum from the first row of the key to the current one; nulls are skipped."""
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(w))
    cut = df.withColumn("_s", slice_by)
    parts = [*keys, "_s"]
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*parts).agg(F.sum(value).alias("_sum")).select(*parts, F.sum("_sum").over(before).alias("_carry"))
    )
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = match(cut.withColumn("_in", F.sum(value).over(inside)), carried, parts)
    added = F.coalesce(F.col("_in") + F.col("_carry"), F.col("_in"), F.col("_carry"))
    return out.withColumn(name, added).drop("_s", "_in", "_carry")


def with_step(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "step", slice_by: Column | None = None
) -> DataFrame:
    """Position of the row within its key, from 1; the order must be total."""
    if slice_by is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(one, keys, order, "_one", name, slice_by).drop("_one")


def with_partition_stat(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Mean, max, first by order (``min_by``) … of the whole key beside every row."""
    return with_group_stat(df, keys, *aggs)


def fill_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill each column with its one non-null value (the smallest, if there are several), as a one-row subquery."""
    return df.withColumns({c: df.agg(F.min(c)).scalar() for c in cols})
