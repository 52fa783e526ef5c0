"""Renames, casts and column-wise clean-up. Each operator adds one projection, never one per column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import blank_to_null as blank
from millrace.functions import normalise_name, to_day, to_number


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a mapping; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def business_names(mapping: DataFrame, columns: Sequence[str], table: str | None = None) -> dict[str, str]:
    """Business name of each technical column, from a table with ``tabla``, ``TEC`` and ``USUARIO``.

    Reads only the mapping rows of the columns given, so at most one row per column comes to the driver.
    """
    rows = mapping.filter(F.col("TEC").isin(*columns))
    if table is not None:
        rows = rows.filter(F.col("tabla") == table)
    named = rows.groupBy("TEC").agg(F.min(normalise_name("USUARIO")).alias("name")).collect()
    return {r["TEC"]: r["name"] for r in named}


def rename_from_mapping(df: DataFrame, mapping: DataFrame, table: str | None = None) -> DataFrame:
    """Rename technical to business names through a mapping table, all in one projection."""
    return df.withColumnsRenamed(business_names(mapping, df.columns, table))


def cast_columns(
    df: DataFrame, numeric: Sequence[str] = (), dates: Sequence[str] = (), fmt: str = "yyyy-MM-dd"
) -> DataFrame:
    """Listed text columns to double and to date; text that does not fit becomes null."""
    typed = {c: to_number(c) for c in numeric if c in df.columns}
    typed |= {c: to_day(c, fmt) for c in dates if c in df.columns}
    return df.withColumns(typed) if typed else df


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def upper_all(df: DataFrame) -> DataFrame:
    """Upper-case every text column; other types stay as they are."""
    return df.withColumns({c: F.upper(c) for c in _strings(df)})


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Blank text becomes null in the listed (default: all text) columns."""
    return df.withColumns({c: blank(c) for c in (_strings(df) if cols is None else cols)})


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name contains the pattern."""
    return df.drop(*[c for c in df.columns if re.search(pattern, c)])


def mask_after(df: DataFrame, cols: Sequence[str], period_col: str, cutoff: date, value: float = 0) -> DataFrame:
    """Set measures to ``value`` in every period after ``cutoff``."""
    late = F.col(period_col) > F.lit(cutoff)
    return df.withColumns({c: F.when(late, F.lit(value)).otherwise(F.col(c)) for c in cols})


def mask_before(df: DataFrame, cols: Sequence[str], period_col: str, cutoff: date, value: float = 0) -> DataFrame:
    """Set measures to ``value`` in every period before ``cutoff``."""
    early = F.col(period_col) < F.lit(cutoff)
    return df.withColumns({c: F.when(early, F.lit(value)).otherwise(F.col(c)) for c in cols})
