"""Totals kept by month: a load touches only the months it has rows of, and reports are made from what is kept."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.reports import month_totals, report_totals
from millrace.sources.versioned import VersionedTable


class KeptTotals:
    """Sums and row counts of the finest level by month, at ``path``.

    Sums of decimals add up and are taken back exactly, so that late, corrected and withdrawn rows leave what a full
    run over the rows that remain would give. A level of the hierarchy without rows left has no row.
    """

    def __init__(self, spark: SparkSession, path: str, hierarchy: Sequence[str], day: str, value: str) -> None:
        self.hierarchy, self.day, self.value = list(hierarchy), day, value
        self.table = VersionedTable(spark, path, [*hierarchy], partition_by=["month"])

    def add(self, rows: DataFrame, withdrawn: DataFrame | None = None, load: str | None = None) -> list[date]:
        """Count a load in, ``withdrawn`` rows out, and return the months that were redone.

        The driver gets the months of the load. A load that is in already changes nothing.
        """
        if load is not None and load in self.table.loads():
            return []
        change = month_totals(rows, self.hierarchy, self.day, self.value)
        if withdrawn is not None:
            out = month_totals(withdrawn, self.hierarchy, self.day, self.value)
            change = change.union(out.select(*self.hierarchy, "month", -F.col("total"), -F.col("rows")))
        months = sorted(r["month"] for r in change.select("month").distinct().toLocalIterator())
        if not self.table.version():
            self.table.append(self._sum(change, change), load)
        else:
            touched = F.col("month").isin(months)
            kept = self.table.read()
            self.table.replace_slice(self._sum(kept.filter(touched).unionByName(change), kept), ~touched, load)
        return months

    def _sum(self, parts: DataFrame, like: DataFrame) -> DataFrame:
        sums = parts.groupBy(*self.hierarchy, "month").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows")).filter("rows <> 0")
        return sums.withColumn("total", F.col("total").cast(like.schema["total"].dataType))

    def report(self, start: date, months: int) -> DataFrame:
        """``totals_report`` of all loads; only the months asked for are read."""
        return report_totals(self.table.read(), self.hierarchy, start, months)
