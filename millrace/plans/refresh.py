"""Cleansed tables out of raw ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import period, strip_zeros
from millrace.operators.columns import business_names, cast_columns
from millrace.operators.filters import drop_empty
from millrace.operators.sets import union_missing
from millrace.operators.snapshots import latest_by_key, snapshot_per_group
from millrace.sources.registry import TableSpec
from millrace.sources.versioned import VersionedTable


def refresh_silver(
    df: DataFrame,
    spec: TableSpec,
    mapping: DataFrame,
    since: datetime | None = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """Typed, newest-version, business-named form of a raw table.

    With ``since`` only loads from one hour before that mark are read; the year of the mark is also asked of the
    ``YEAR`` partition, so older folders are not opened. ``current`` is the cleansed table so far: its rows and the
    increment compete under the same key, so a delta never loses old rows and never leaves two versions.
    """
    if since is not None:
        mark = since - timedelta(hours=1)
        # A day of slack for the year, which may have been taken in another time zone.
        year = (mark - timedelta(days=1)).year
        df = df.filter((F.col("YEAR") >= year) & (F.col("SEQ_DATE") >= F.lit(mark)))
    typed = cast_columns(df, spec.numeric, spec.dates)
    names = business_names(mapping, df.columns, spec.name)
    rows = typed.withColumnsRenamed(names)
    if current is not None:
        rows = union_missing(current, rows)
    return latest_by_key(rows, [names.get(k, k) for k in spec.keys], [names.get(c, c) for c in spec.order_by])


def store_silver(
    df: DataFrame, spec: TableSpec, mapping: DataFrame, path: str, since: datetime | None = None, load: str | None = None
) -> VersionedTable:
    """Refresh the cleansed table at ``path`` from a raw one, by the load mode of its specification.

    ``append`` merges the loads from one hour before ``since`` on into the stored table, which rewrites the files with
    their keys; ``overwrite`` makes the table anew. Readers see the old table or the new one.
    """
    names = business_names(mapping, df.columns, spec.name)
    named = lambda columns: [names.get(c, c) for c in columns]
    table = VersionedTable(df.sparkSession, path, named(spec.keys), partition_by=named(spec.partition_by))
    if spec.load_mode == "append":
        table.merge(refresh_silver(df, spec, mapping, since if table.version() else None), named(spec.order_by), load)
    else:
        table.replace(refresh_silver(df, spec, mapping), load)
    return table


def refresh_fact(
    df: DataFrame,
    loaded: str,
    *,
    month: str | None = None,
    pick: str = "max",
    shift_days: int = 0,
    keys_to_strip: Sequence[str] = ("material",),
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fact extract reduced to one load per month: the newest (or with ``pick="min"`` the first).

    The month is a column of the table, or the month of the load day moved back by ``shift_days`` (a load made on the
    first shows the end of the month before). Fully empty rows and repeated rows go; keys lose their leading zeros.
    """
    columns = df.columns
    rows = drop_empty(df, "all", columns)
    if month is None:
        month = "month"
        rows = rows.withColumn(month, period(F.date_sub(F.col(loaded).cast("date"), shift_days)))
    kept = snapshot_per_group(rows, [month], loaded, pick, calendar_groups=True)
    stripped = kept.withColumns({k: strip_zeros(k, 2) for k in keys_to_strip})
    return stripped.withColumnsRenamed(dict(names or {})).distinct()
