"""Aggregations. All of them combine on the map side, so the shuffle carries one partial row per key and task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import ratio
from millrace.operators.joins import SALTS, match
from millrace.operators.skew import match_skewed
from millrace.operators.snapshots import Order, latest_by_key


def sum_all(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Sum of the listed (default: all numeric) columns per key, under their own names."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def agg_by_kind(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), avgs: Sequence[str] = ()) -> DataFrame:
    """Quantities are summed; prices and rates are averaged."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in avgs])


def sum_by_sets(df: DataFrame, keys: Sequence[str], value: str, sets: Mapping[str, Column]) -> DataFrame:
    """One sum per named condition, in one pass; 0 where a key has no row in the set."""
    sums = [F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0)).alias(name) for name, cond in sets.items()]
    return df.groupBy(*keys).agg(*sums)


def two_level(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, aggs: Mapping[str, str]
) -> DataFrame:
    """Totals per ``inner`` key, then statistics of those totals per ``outer`` key.

    ``aggs`` maps an output name to the name of an aggregate function.
    """
    totals = df.groupBy(*inner).agg(F.sum(value).alias("_total"))
    return totals.groupBy(*outer).agg(*[getattr(F, fn)("_total").alias(name) for name, fn in aggs.items()])


def distinct_rows(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[Order] | None = None
) -> DataFrame:
    """Distinct rows; with ``subset`` one row per key, the first in ``order_by`` (names sort descending)."""
    if subset is None:
        return df.distinct()
    if order_by is None:
        raise ValueError("one row per key needs an order, or the row kept is arbitrary")
    return latest_by_key(df, subset, order_by)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unit_price(df: DataFrame, keys: Sequence[str], value: str, units: str, name: str = "unit_price") -> DataFrame:
    """Weighted price: sum of values over sum of units; null without units."""
    return df.groupBy(*keys).agg(ratio(F.sum(value), F.sum(units)).alias(name))


def attainment(df: DataFrame, keys: Sequence[str], num: str, den: str) -> DataFrame:
    """Both sums and their ratio in percent, worked out from the sums (percentages are never added up)."""
    sums = df.groupBy(*keys).agg(F.sum(num).alias(num), F.sum(den).alias(den))
    return sums.withColumn("attainment", 100 * ratio(num, den))


def total(df: DataFrame, agg: Column) -> Column:
    """One aggregate over the whole table, as a scalar subquery to use in a select or filter of another table."""
    return df.agg(agg).scalar()


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median", accuracy: int = 2000) -> DataFrame:
    """Exact median per key for groups of any size.

    Spark's own ``median`` keeps every distinct value of a group in the memory of one task. Here an approximate
    percentile first sets a narrow bracket around the middle of each group; rows are counted below, inside and above
    the bracket, and only the zone that holds the middle rank is sorted, one row per distinct value with its count.
    The ranks come from exact counts, so the result is exact even if the bracket is off: then another zone is sorted.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    edge = 2.0 / accuracy
    brackets = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", [0.5 - edge, 0.5 + edge], 2 * accuracy).alias("_b"),
    )
    zone = F.when(F.col("_v") < F.col("_b")[0], -1).when(F.col("_v") > F.col("_b")[1], 1).otherwise(0)
    # Equal values are folded before the join back, so a hot group shrinks to its distinct values on the map side.
    values = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    zoned = match(values, brackets, keys, "inner", SALTS).withColumn("_z", zone).drop("_b")
    counts = zoned.groupBy(*keys).agg(
        F.sum(F.when(F.col("_z") < 0, F.col("_n")).otherwise(0)).alias("_low"),
        F.sum(F.when(F.col("_z") <= 0, F.col("_n")).otherwise(0)).alias("_mid"),
        F.sum("_n").alias("_all"),
    )
    first = F.floor((F.col("_all") + 1) / 2)
    second = F.floor(F.col("_all") / 2) + 1
    wanted = counts.select(*keys, "_low", "_mid", first.alias("_r1"), second.alias("_r2"))
    below = F.when(F.col("_z") < 0, F.lit(0)).when(F.col("_z") == 0, F.col("_low")).otherwise(F.col("_mid"))
    upto = F.when(F.col("_z") < 0, F.col("_low")).when(F.col("_z") == 0, F.col("_mid"))
    kept = (
        match(zoned, wanted, keys, "inner", SALTS)
        .withColumns({"_below": below, "_upto": upto})
        .filter((F.col("_r2") > F.col("_below")) & (F.col("_upto").isNull() | (F.col("_r1") <= F.col("_upto"))))
    )
    run = F.sum("_n").over(Window.partitionBy(*keys, "_z").orderBy("_v")) + F.col("_below")
    ranked = kept.withColumn("_hi", run).withColumn("_lo", F.col("_hi") - F.col("_n"))
    holds1 = (F.col("_lo") < F.col("_r1")) & (F.col("_hi") >= F.col("_r1"))
    holds2 = (F.col("_lo") < F.col("_r2")) & (F.col("_hi") >= F.col("_r2"))
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(holds1, F.col("_v"))) + F.max(F.when(holds2, F.col("_v")))) / 2).alias(name)
    )


def spread_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median, both standard deviations and the sample variance; a single row gives null for the sample forms."""
    stats = df.groupBy(*keys).agg(
        F.stddev_samp(value).alias("sd_samp"),
        F.stddev_pop(value).alias("sd_pop"),
        F.var_samp(value).alias("var_samp"),
    )
    return match(stats, exact_median(df, keys, value), keys)


def with_group_stat(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregates of the key's group beside every detail row.

    The group is aggregated and joined back, heavy keys cut into pieces, instead of read through a window, which would
    hold it in one task.
    """
    return match_skewed(df, df.groupBy(*keys).agg(*aggs), keys)


def with_group_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Median of the key's group beside every detail row."""
    return match_skewed(df, exact_median(df, keys, value, name), keys)
