"""Keep-latest versioning, snapshot choice and top-n.

``latest_by_key`` and ``top_n`` keep the ``row_number() <= n`` shape: Spark then cuts every map task's rows to ``n``
per key *before* the shuffle, so a key that holds a third of the table sends a handful of rows to its reducer.
The snapshot operators keep whole loads, which may be large, so they never put a group into a window: the chosen
load time per group is a partial aggregate, and the rows are found again by an equi-join, broadcast where the groups
are calendar periods and with heavy loads cut into pieces where they may be anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import match
from millrace.operators.skew import match_skewed

Order = Column | str


def _desc(order_by: Sequence[Order]) -> list[Column]:
    return [F.desc(o) if isinstance(o, str) else o for o in order_by]


def top_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[Order], n: int) -> DataFrame:
    """First ``n`` rows per key. Plain names in ``order_by`` sort descending; the order must be total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_desc(order_by)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Order]) -> DataFrame:
    """Newest version of every key. Plain names in ``order_by`` sort descending; the order must be total."""
    return top_n(df, keys, order_by, 1)


def _pick(pick: str):
    if pick not in ("max", "min"):
        raise ValueError("pick is 'max' or 'min'")
    return F.max if pick == "max" else F.min


def snapshot_per_group(
    df: DataFrame, group: Sequence[str], ts: str, pick: str = "max", calendar_groups: bool = False
) -> DataFrame:
    """All rows of the newest (or oldest) load of each group; rows that share the load time all stay.

    ``calendar_groups`` states that a group is a calendar period, so that there are at most a few thousand of them: the
    chosen loads are then broadcast and the table is not shuffled at all. Otherwise heavy loads are cut into pieces.
    """
    chosen = df.groupBy(*group).agg(_pick(pick)(ts).alias(ts))
    if calendar_groups:
        return match(df, F.broadcast(chosen), [*group, ts], how="left_semi")
    return match_skewed(df, chosen, [*group, ts], "left_semi")


def snapshot_overall(df: DataFrame, ts: str, pick: str = "max") -> DataFrame:
    """All rows of the newest (or oldest) load of the table. The load time is a one-row subquery, not a join."""
    return df.filter(F.col(ts) == df.agg(_pick(pick)(ts)).scalar())


def snapshot_two_stage(df: DataFrame, ts: str, within: str = "month", pick: str = "min") -> DataFrame:
    """The first (or last) load of the newest period.

    The first loads of the periods come in the order of the periods, so the one wanted is the greatest of them; the
    last load of the newest period is the newest load of all. Either is a one-row subquery.
    """
    if pick == "max":
        return snapshot_overall(df, ts, "max")
    start = F.date_trunc(within, F.col(ts).cast("timestamp_ntz"))
    firsts = df.groupBy(start.alias("_p")).agg(F.min(ts).alias("_first"))
    return df.filter(F.col(ts) == firsts.agg(F.max("_first")).scalar())


def opening_snapshot(df: DataFrame, keys: Sequence[str], document_day: str, as_of, order_by: Sequence[Order]) -> DataFrame:
    """Rows dated on the first of the month of ``as_of``, newest version per key."""
    return latest_by_key(df.filter(F.col(document_day).cast("date") == F.lit(as_of.replace(day=1))), keys, order_by)
