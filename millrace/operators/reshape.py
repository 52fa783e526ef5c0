"""Unpivot, pivot, measure reshape, month ladders and spines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str) -> DataFrame:
    """Listed columns become rows of (name, value); null values stay as rows."""
    return df.unpivot(list(ids), list(values), var, val)


def pivot(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, *aggs: Column
) -> DataFrame:
    """Pivot over an explicit value list: no extra job for the values and a schema that does not move."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(*aggs)


def measure_reshape(
    df: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, Mapping[str, str]],
    pivot_attr: str,
    averaged: Sequence[str] = (),
) -> DataFrame:
    """Wide measures to rows tagged with attributes, one attribute spread over columns.

    ``measures`` gives every measure its attribute values, for example
    ``{"qty": {"unit": "PIECES", "kind": "ORDERED"}}``. The result has one row per id and combination of the
    attributes other than ``pivot_attr``, and one column per value of ``pivot_attr``. Measures that share a cell are
    added; those in ``averaged`` are averaged over their non-null rows.

    Since the map is known beforehand, the measures are aggregated per id first and the few result rows are expanded
    afterwards: one shuffle of one row per id, where unpivot, join, group and pivot would shuffle one row per measure.
    """
    others = [a for a in next(iter(measures.values())) if a != pivot_attr]
    columns = list(dict.fromkeys(m[pivot_attr] for m in measures.values()))
    rows = list(dict.fromkeys(tuple(m[a] for a in others) for m in measures.values()))
    aggs = []
    for m in measures:
        aggs.append(F.sum(m).alias(f"_sum_{m}"))
        if m in averaged:
            aggs.append(F.count(m).alias(f"_cnt_{m}"))
    grouped = df.groupBy(*ids).agg(*aggs)

    def cell(row: tuple, column: str) -> Column:
        here = [m for m, a in measures.items() if a[pivot_attr] == column and tuple(a[o] for o in others) == row]
        if not here:
            return F.lit(None).cast("double")
        added = F.coalesce(*[F.col(f"_sum_{m}") for m in here])
        if len(here) > 1:
            some = F.coalesce(*[F.col(f"_sum_{m}") for m in here]).isNotNull()
            added = F.when(some, sum((F.coalesce(F.col(f"_sum_{m}"), F.lit(0)) for m in here), F.lit(0)))
        if any(m in averaged for m in here):
            return F.try_divide(added, sum((F.col(f"_cnt_{m}") for m in here), F.lit(0))).cast("double")
        return added.cast("double")

    structs = [
        F.struct(
            *[F.lit(v).alias(a) for a, v in zip(others, row)],
            *[cell(row, c).alias(c) for c in columns],
        )
        for row in rows
    ]
    return grouped.select(*ids, F.inline(F.array(*structs)))


def months_from(start: date, n: int) -> list[date]:
    """``n`` month starts from the month of ``start``."""
    return [start.replace(day=1) + relativedelta(months=i) for i in range(n)]


def month_spine(spark: SparkSession, start: date, n: int, name: str = "month") -> DataFrame:
    """One row per month, ``n`` of them."""
    first = start.replace(day=1)
    last = first + relativedelta(months=n - 1)
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))


def month_ladder(
    df: DataFrame, keys: Sequence[str], day: str, value: str, suffix: str, start: date, months: int
) -> DataFrame:
    """One row per key and one column per month of the horizon, labelled ``yyyy-MM`` plus suffix; 0 where missing.

    Rows outside the horizon are filtered before the shuffle. A pivot over known values sums per key and month first,
    which spreads a hot key over its months; only those few sums are spread over the columns.
    """
    steps = months_from(start, months + 1)
    inside = df.filter((F.col(day) >= F.lit(steps[0])) & (F.col(day) < F.lit(steps[-1])))
    labels = [f"{m:%Y-%m}" for m in steps[:-1]]
    month = F.date_format(F.col(day).cast("date"), "yyyy-MM")
    wide = inside.withColumn("_m", month).groupBy(*keys).pivot("_m", labels).agg(F.sum(value))
    return wide.na.fill(0, labels).withColumnsRenamed({m: f"{m}{suffix}" for m in labels})


def with_amounts(
    df: DataFrame, cols: Sequence[str], price: Column, tag: str = "concept", units: str = "PIECES", amounts: str = "AMOUNT"
) -> DataFrame:
    """Every row twice: as it is, and with the listed columns times the price. Expanded in place, without a union."""
    rest = [c for c in df.columns if c not in cols]
    priced = df.withColumn("_price", price.cast("double"))
    as_units = F.struct(F.lit(units).alias(tag), *[F.col(c).cast("double").alias(c) for c in cols])
    as_amount = F.struct(F.lit(amounts).alias(tag), *[(F.col(c).cast("double") * F.col("_price")).alias(c) for c in cols])
    return priced.select(*rest, F.inline(F.array(as_units, as_amount)))
