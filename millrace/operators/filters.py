"""Row filters. All are plain predicates on input columns, so they reach the file scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def open_items(df: DataFrame, deleted: str, complete: str) -> DataFrame:
    """Items not flagged as deleted (null or blank) and not completely delivered (anything but ``X``)."""
    kept = F.col(deleted).isNull() | (F.trim(F.col(deleted)) == "")
    return df.filter(kept & ~F.col(complete).eqNullSafe(F.lit("X")))


def last_months(df: DataFrame, c: str, n: int, as_of: date) -> DataFrame:
    """Rows dated within the ``n`` months that end on ``as_of``, that day included."""
    return df.filter((F.col(c) > F.lit(as_of - relativedelta(months=n))) & (F.col(c) < F.lit(as_of + relativedelta(days=1))))


def from_month(df: DataFrame, c: str, as_of: date) -> DataFrame:
    """Rows dated in the month of ``as_of`` or later."""
    return df.filter(F.col(c) >= F.lit(as_of.replace(day=1)))


def drop_empty(df: DataFrame, how: str = "all", subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which all (or any) of the columns are null."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)
