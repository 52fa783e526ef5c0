"""Incremental file ingest as a run-to-completion stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.ingest import plain_paths, stamp_load
from millrace.sources.scans import CORRUPT, json_reader
from millrace.sources.writers import write_table
from millrace.streaming.arrivals import arrivals


def ingest_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    *,
    rename: Mapping[str, str] | None = None,
    loaded_at: datetime | None = None,
    partition_by: Sequence[str] = ("YEAR",),
    quarantine: str | None = None,
    multiline: bool = False,
    max_files_per_batch: int = 10_000,
) -> None:
    """Append every file that arrived since the last run, then stop.

    The stream's checkpoint takes the place of a load log. A file delivered again under its old name counts as new, and
    so does one that comes late with an older time. Each batch of files writes its own ``LOAD`` partition and replaces
    it when the batch is repeated after a failure, so a row is never loaded twice. Rows carry the modification time of
    their file (or ``loaded_at``); unreadable records go to ``quarantine`` with their file. The driver holds the paths
    of one batch at a time.
    """
    stream = arrivals(spark, source, f"{checkpoint.rstrip('/')}/arrivals", max_files_per_batch)

    def load_files(number: int, paths: list[str]) -> None:
        reader = json_reader(spark.read, schema, multiline, False, quarantine is not None)
        rows = reader.json(plain_paths(paths)).select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_file_time"),
        )
        rows = rows.withColumn("LOAD", F.lit(number).cast("long"))
        if quarantine is not None:
            bad = rows.filter(F.col(CORRUPT).isNotNull())
            write_table(bad, quarantine, ["LOAD"], replace_partitions=True)
            rows = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        stamp = F.col("_file_time") if loaded_at is None else F.lit(loaded_at)
        good = stamp_load(rows, stamp).drop("_file", "_file_time").withColumnsRenamed(dict(rename or {}))
        write_table(good, target, [*partition_by, "LOAD"], replace_partitions=True)

    def load(batch: DataFrame, _: int) -> None:
        files = batch.select("batch", "path")
        numbers = files.select("batch").distinct().orderBy("batch")
        for number in [r["batch"] for r in numbers.toLocalIterator()]:
            wanted = files.filter(F.col("batch") == number).select("path")
            load_files(number, [r["path"] for r in wanted.toLocalIterator()])  # at most max_files_per_batch

    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
