"""Subtotal reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import ratio
from millrace.operators.reshape import months_from


def month_totals(df: DataFrame, hierarchy: Sequence[str], day: str, value: str) -> DataFrame:
    """(hierarchy, month, total, rows): sums of the finest level by month, of which every report is made."""
    month = F.trunc(F.col(day).cast("date"), "month").alias("month")
    return df.groupBy(*hierarchy, month).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("rows"))


def report_totals(fine: DataFrame, hierarchy: Sequence[str], start: date, months: int) -> DataFrame:
    """``totals_report`` from the rows of ``month_totals``."""
    steps = months_from(start, months + 1)
    inside = fine.filter((F.col("month") >= F.lit(steps[0])) & (F.col("month") < F.lit(steps[-1])))
    labels = [f"{m:%Y-%m}" for m in steps[:-1]]
    cells = [
        F.coalesce(F.sum(F.when(F.col("month") == F.lit(m), F.col("total"))), F.lit(0)).alias(label)
        for m, label in zip(steps, labels)
    ]
    report = inside.rollup(*hierarchy).agg(*cells, F.sum("total").alias("total"), F.grouping_id().alias("level"))
    return report.withColumn("mean", F.col("total").cast("double") / months)


def totals_report(
    df: DataFrame, hierarchy: Sequence[str], day: str, value: str, start: date, months: int
) -> DataFrame:
    """Months across, the hierarchy and its subtotals down, with the total and the monthly mean of the horizon.

    Rows are summed to the finest level and month first, so the rollup multiplies totals and not detail rows.
    ``level`` is Spark's grouping id: 0 for the finest rows, all ones for the grand total.
    """
    steps = months_from(start, months + 1)
    inside = df.filter((F.col(day) >= F.lit(steps[0])) & (F.col(day) < F.lit(steps[-1])))
    return report_totals(month_totals(inside, hierarchy, day, value), hierarchy, start, months)


def quarter_means(df: DataFrame, keys: Sequence[str], day: str, value: str, revised: str) -> DataFrame:
    """Quarter totals, their mean per month, and the share of the total over a revised measure in percent."""
    quarters = df.groupBy(*keys, F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(
        F.sum(value).alias("total"), F.sum(revised).alias("_revised")
    )
    return quarters.withColumns(
        {"monthly_mean": F.col("total").cast("double") / 3, "attainment": 100 * ratio("total", "_revised")}
    ).drop("_revised")
