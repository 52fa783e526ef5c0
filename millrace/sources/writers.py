"""Table and report writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    *,
    copy_partition_cols: bool = False,
    files: int | None = None,
    compression: str = "snappy",
    replace_partitions: bool = False,
) -> None:
    """Write Parquet, by partition folders if asked.

    With partitions the rows are rebalanced on them first: small partitions get one file each instead of one per
    task, and adaptive execution cuts a large partition into several files written by several tasks.
    ``copy_partition_cols`` partitions by copies (``<name>_1``), so the columns also stay in the files.
    ``replace_partitions`` overwrites only the partitions that the new rows touch. ``files`` fixes the file count.
    """
    by = list(partition_by)
    if copy_partition_cols:
        df = df.withColumns({f"{c}_1": F.col(c) for c in by})
        by = [f"{c}_1" for c in by]
    if files is not None:
        df = df.repartition(files)
    elif by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode).option("compression", compression)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON-lines manifest, for example recipient and file path."""
    df.write.mode("overwrite").json(path)


def recipient_slug(c: Column | str) -> Column:
    """Folder name of a recipient: the part of the address before ``@``, dots as underscores."""
    value = F.col(c) if isinstance(c, str) else c
    return F.translate(F.substring_index(value, "@", 1), ".", "_")


def recipient_rows(
    df: DataFrame, own: Sequence[str], see_all: Sequence[str] = (), name: str = "recipient"
) -> DataFrame:
    """One copy of a row per reader: those named in the ``own`` columns, and the readers who see everything.

    The copies are exploded in place; a reader named twice on a row gets it once, and blank names get nothing.
    """
    readers = F.array_distinct(F.array(*[F.col(c) for c in own], *[F.lit(r) for r in see_all]))
    shown = F.filter(readers, lambda r: r.isNotNull() & (F.trim(r) != ""))
    return df.select("*", F.explode(shown).alias(name))


def export_by_recipient(df: DataFrame, recipient: str, path: str, fmt: str = "csv") -> None:
    """One folder per recipient, written by a single job."""
    out = df.withColumn("slug", recipient_slug(recipient)).hint("rebalance", "slug")
    writer = out.write.mode("overwrite").partitionBy("slug")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
