"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.workspace import new_path

#: Bytes of one Arrow batch. Rows of long texts then reach a Python worker a few at a time.
BATCH_BYTES = 8 << 20


def with_small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, unless the session already sets a bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet below the shared folder and read from there.

    Cuts the lineage: a lost executor costs at most the tasks that read, never the work above.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``. A null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quantiles(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` rising boundaries that cut the whole numbers of ``key`` into even parts.

    One pass with a mergeable sketch; the driver gets ``parts`` numbers, whatever the size of ``df``.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(F.col(key), shares, 20 * parts).alias("q")).first()["q"]
    return sorted(set(got or []))


def memo(build: Callable, *args):
    """``build(*args)``, kept for the life of the Python worker. The arguments must be hashable."""
    key = (build.__module__, build.__qualname__, args)
    if key not in _MEMO:
        _MEMO[key] = build(*args)
    return _MEMO[key]


_MEMO: dict = {}
