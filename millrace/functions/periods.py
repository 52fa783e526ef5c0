"""Days, months and ``yyyy-MM`` period labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.keys import _col

PERIOD_FORMAT = "yyyy-MM"
DAY_FORMAT = "yyyy-MM-dd"


def to_day(c: Column | str, fmt: str = DAY_FORMAT) -> Column:
    """Parse text to a date; text that does not fit gives null, also under ANSI mode.

    The default format is read by a cast, which costs half of a formatter, after a look at the shape of the text.
    """
    if fmt == DAY_FORMAT:
        text = _col(c).cast("string")
        return F.when(text.like("____-__-__") & (F.length(F.trim(text)) == 10), text.try_cast("date"))
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt)).cast("date")


def period(c: Column | str) -> Column:
    """``yyyy-MM`` label of a date or timestamp."""
    return F.date_format(_col(c), PERIOD_FORMAT)


def month_start(c: Column | str) -> Column:
    """First day of the month, from a date, a timestamp or a ``yyyy-MM`` label."""
    return F.trunc(_col(c).cast("date"), "month")


def shift_period(c: Column | str, n: int) -> Column:
    """``yyyy-MM`` label moved by ``n`` months, across year ends."""
    return F.date_format(F.add_months(_col(c).cast("date"), n), PERIOD_FORMAT)


def extract_period(c: Column | str) -> Column:
    """First ``yyyy-MM`` found in a file name or date text; null when there is none."""
    return F.nullif(F.regexp_extract(_col(c), r"(\d{4}-\d{2})", 1), F.lit(""))


def key_timestamp(c: Column | str, fmt: str = "yyyyMMddHHmmss") -> Column:
    """Timestamp held in a text key; null when the key does not fit the format."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt))


def in_period(c: Column | str, start: date | str, end: date | str) -> Column:
    """Month of ``c`` lies between two months, both included. Bounds are dates or ``yyyy-MM`` labels.

    Written as a plain range on ``c`` (``>= first day`` and ``< first day after``), so it reaches the scan.
    """
    first = _first_of_month(start)
    after = _first_of_month(end)
    after = date(after.year + after.month // 12, after.month % 12 + 1, 1)
    return (_col(c) >= F.lit(first)) & (_col(c) < F.lit(after))


def _first_of_month(d: date | str) -> date:
    if isinstance(d, str):
        year, month = d.split("-")[:2]
        return date(int(year), int(month), 1)
    return d.replace(day=1)
