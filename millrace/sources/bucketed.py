"""Tables written in buckets of their key, so that chains of joins on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.joins import left_join_all
from millrace.sources.workspace import new_path


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Write a table with one sorted file per bucket of ``keys`` and give it back as it is read from there.

    The table is registered under ``name`` in the session's catalog, which keeps the buckets; without a name and a path
    it is meant for this session, in the shared folder. Tables with equal keys and bucket numbers are joined on the keys
    bucket by bucket. Choose the number so that a bucket fits in a task: Spark reads one bucket per task.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(buckets, *keys)  # the hash that buckets go by, so that a bucket is one file
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    writer.option("path", path or new_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def star_chain(spine: DataFrame, measures: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Spine left-joined with measure tables that have one row per key, all written by ``write_bucketed``."""
    return left_join_all(spine, [(m, list(keys)) for m in measures])


def join_by_leading_key(spark: SparkSession) -> None:
    """Let joins on more columns than the bucket key, such as item and month, keep to the buckets of the key."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
