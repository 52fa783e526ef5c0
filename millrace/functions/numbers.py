"""Numbers out of text, safe ratios and clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.keys import _col


def to_number(c: Column | str) -> Column:
    """Text to double; text that is no number gives null, also under ANSI mode."""
    return _col(c).try_cast("double")


def clean_number(c: Column | str, scale: int = 2) -> Column:
    """Keep digits and dots, read the rest as double and round. A minus sign is dropped too."""
    return F.round(F.regexp_replace(_col(c).cast("string"), "[^0-9.]", "").try_cast("double"), scale)


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; null when the denominator is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def clamp(c: Column | str, lo: Column | float | None = 0, hi: Column | float | None = None) -> Column:
    """Keep ``c`` within ``lo`` and ``hi``; null stays null (``greatest`` alone would turn it into ``lo``)."""
    value = _col(c)
    out = value
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(value.isNotNull(), out)
