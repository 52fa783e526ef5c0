"""Unions and period replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null there."""
    return a.unionByName(b, allowMissingColumns=True)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name of any number of tables, over the superset of their columns."""
    return reduce(union_missing, dfs)


def replace_slice(old: DataFrame, new: DataFrame, inside: Column) -> DataFrame:
    """Old rows outside the slice plus new rows inside it. A null predicate counts as outside."""
    return old.filter(~inside.eqNullSafe(True)).unionByName(new.filter(inside))
