"""Column functions: keys, periods, numbers and codes. All return a ``Column`` and stay on the JVM."""

from millrace.functions.codes import bucket, map_code, map_unit
from millrace.functions.keys import (
    blank_to_null,
    composite_key,
    has_text,
    normalise_name,
    pad_key,
    strip_zeros,
)
from millrace.functions.numbers import clamp, clean_number, ratio, to_number
from millrace.functions.periods import (
    extract_period,
    in_period,
    key_timestamp,
    month_start,
    period,
    shift_period,
    to_day,
)

__all__ = [
    "blank_to_null",
    "bucket",
    "clamp",
    "clean_number",
    "composite_key",
    "extract_period",
    "has_text",
    "in_period",
    "key_timestamp",
    "map_code",
    "map_unit",
    "month_start",
    "normalise_name",
    "pad_key",
    "period",
    "ratio",
    "shift_period",
    "strip_zeros",
    "to_day",
    "to_number",
]
