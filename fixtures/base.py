"""Registry and table access for the fixture queries."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The test tables' "today": the order tables end in 2001, the event table in January 2024.
AS_OF = date(1998, 6, 15)
EVENTS_AS_OF = date(2024, 1, 31)


def with_folder(spark: SparkSession) -> SparkSession:
    """A session of one machine that names no shared folder gets a temporary one; any other session is left as it is."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark


def query(name: str, sql: str | None = None):
    """Register a query and, if it has one, its SQL twin."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = functools.wraps(fn)(lambda spark, sf_dir: fn(with_folder(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: Column | str) -> Column:
    """Fixed-point amount, so that sums do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def number(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def round6(c: Column | str) -> Column:
    return F.round(number(c), 6)
