"""Reconciliation of two tables by digests: only what differs is compared row by row.

The digest of a set of rows is their number and the sum of their 64-bit hashes, so it does not depend on the order of
rows, digests of parts add up, and what is taken away is subtracted. Rows are dealt to buckets by a hash of their key. Digests of the buckets can be kept beside a table as a
tree; two trees are compared from the root down, and only rows of buckets that differ are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.skew import key_hash

# Buckets of a table, and nodes of the tree above them.
BUCKETS = 1 << 16
NODES = 1 << 8


def _hash(columns: Sequence[str]) -> Column:
    return key_hash(columns).cast("decimal(38,0)")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(key_hash(keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, total) of every bucket that has rows; all columns count, in the order of their names."""
    hashed = df.select(_bucket(keys, buckets).alias("bucket"), _hash(sorted(df.columns)).alias("h"))
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("h").alias("total"))


def add_digests(*parts: DataFrame) -> DataFrame:
    """Digests of all rows from digests of parts of them."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))


def _differing(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    minus = b.select(by, (-F.col("rows")).alias("rows"), (-F.col("total")).cast("decimal(38,0)").alias("total"))
    sums = a.select(by, "rows", "total").union(minus).groupBy(by).agg(F.sum("rows").alias("r"), F.sum("total").alias("t"))
    return sums.filter((F.col("r") != 0) | (F.col("t") != 0)).select(by)


def differing_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(bucket) where two lists of digests differ."""
    return _differing(a, b, "bucket")


class KeptDigests:
    """Digests at ``path`` as a tree: ``NODES`` sums, and the buckets of each in a partition of its own."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, leaves: DataFrame) -> None:
        by_node = leaves.withColumn("node", F.pmod("bucket", F.lit(NODES)))
        by_node.repartition("node").write.mode("overwrite").partitionBy("node").parquet(f"{self.path}/leaves")
        sums = self.leaves().groupBy("node").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
        sums.write.mode("overwrite").parquet(f"{self.path}/nodes")

    def leaves(self) -> DataFrame:
        return self.spark.read.schema("bucket int, rows bigint, total decimal(38,0), node int").parquet(f"{self.path}/leaves")

    def nodes(self) -> DataFrame:
        return self.spark.read.schema("node int, rows bigint, total decimal(38,0)").parquet(f"{self.path}/nodes")

    def differing(self, other: KeptDigests) -> DataFrame:
        """(bucket) where two trees differ; buckets below nodes that agree are not read."""
        nodes = [r["node"] for r in _differing(self.nodes(), other.nodes(), "node").toLocalIterator()]  # at most NODES
        below = [side.leaves().filter(F.col("node").isin(nodes)) for side in (self, other)]
        return differing_buckets(*below)


def reconcile_rows(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    *,
    differing: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys whose rows differ, with ``state``: ``only_left``, ``only_right`` or ``changed``.

    Both tables have the same columns; a key may have several rows, which are compared as a whole, and null keys are
    keys like any other. ``differing`` lists the buckets that differ, from kept digests; without it digests are worked
    out first, from one pass over each table that shuffles a row per bucket and task. Only rows in differing buckets
    are shuffled.
    """
    if differing is None:
        differing = differing_buckets(digests(a, keys, buckets), digests(b, keys, buckets))
    wanted = F.broadcast(differing.withColumnRenamed("bucket", "_bucket"))  # one row per bucket

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.withColumns({"_bucket": _bucket(keys, buckets), "_h": _hash(sorted(df.columns)) * sign, "_side": F.lit(sign)})
        return rows.join(wanted, "_bucket", "left_semi").select(*keys, "_h", "_side")

    both = side(a, 1).union(side(b, -1))
    left, right = F.count_if(F.col("_side") == 1), F.count_if(F.col("_side") == -1)
    found = both.groupBy(*keys).agg(left.alias("_l"), right.alias("_r"), F.sum("_h").alias("_d"))
    state = F.when(F.col("_r") == 0, "only_left").when(F.col("_l") == 0, "only_right").otherwise("changed")
    return found.filter((F.col("_l") != F.col("_r")) | (F.col("_d") != 0)).select(*keys, state.alias("state"))
