"""Queries over the test tables, each with its SQL twin where SQL can express it."""

from fixtures import (  # noqa: F401
    aggregates,
    catalogue,
    columns,
    forecasts,
    imports,
    inventory,
    joins,
    kept,
    orders,
    planning,
    purchasing,
    reports,
    reshape,
    scalars,
    scans,
    versions,
    windows,
)
from fixtures.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
