"""Code to label mappings and range labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.keys import _col


def map_code(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Label of a code; ``default`` (a literal, a column or null) for codes not in the mapping."""
    value = _col(c)
    out: Column | None = None
    for code, label in mapping.items():
        out = F.when(value == code, label) if out is None else out.when(value == code, label)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def map_unit(c: Column | str, mapping: Mapping[str, str] | None = None) -> Column:
    """Exact unit-of-measure replacement, ``ST`` to ``PC`` unless told otherwise; other units stay."""
    return map_code(c, {"ST": "PC"} if mapping is None else mapping, default=_col(c))


def bucket(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Range label, upper edges included. Values above the last edge, and null, get the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label per edge and one for the rest")
    out: Column | None = None
    for edge, label in zip(edges, labels):
        cond = _col(c) <= edge
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(labels[-1]) if out is None else out.otherwise(labels[-1])
