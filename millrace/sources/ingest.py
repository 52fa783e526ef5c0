"""Batch ingest against the load log."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.listing import list_files
from millrace.sources.load_log import Watermark
from millrace.sources.scans import scan_json
from millrace.sources.shared_files import lease
from millrace.sources.writers import write_table

# Characters of a path that a reader would take for a pattern.
GLOB = re.compile(r"[\[\]{}*?\\]")
# Files of one read; their paths are on the driver.
FILES_PER_READ = 10_000


def plain_paths(paths: Sequence[str]) -> list[str]:
    """Paths that a reader takes as they are."""
    return [GLOB.sub(r"\\\g<0>", p) for p in paths]


def stamp_load(df: DataFrame, seq_date) -> DataFrame:
    """Add the load time and its year and month."""
    stamped = df.withColumn("SEQ_DATE", seq_date)
    return stamped.withColumns({"YEAR": F.year("SEQ_DATE"), "MONTH": F.month("SEQ_DATE")})


def ingest_since(
    spark: SparkSession,
    table: str,
    source: str,
    target: str,
    schema: T.StructType,
    marks: Watermark,
    *,
    rename: Mapping[str, str] | None = None,
    loaded_at: datetime | None = None,
    partition_by: Sequence[str] = ("YEAR",),
    files: int | None = None,
    files_per_read: int = FILES_PER_READ,
    take_over: bool = False,
) -> datetime:
    """Load the files that are not loaded yet, each exactly once, and move the mark to the newest of them.

    A file is known by its path and modification time, and ``marks`` keeps what is loaded: one that arrives late with
    an older time is loaded, and so is one delivered again under the same name with another time. Files up to the
    default of ``marks`` are left alone. Rows carry the modification time of their file, or ``loaded_at`` when given.

    A load has two steps. Its rows go to ``LOAD`` partitions of their own and its files to a list; then one row in the
    log commits both. ``read_loaded`` shows committed loads only, so what a load that died has written is never seen,
    and the next run loads its files again. A lease keeps a second loader of the table out; ``take_over`` takes the
    lease of one that died. Returns the new mark. The driver holds ``files_per_read`` paths or so at a time.
    """
    load = uuid.uuid4().hex
    with lease(spark, f"{marks.leases}/{table}", load, take_over):
        listing = list_files(spark, source).filter((F.col("modified") > F.lit(marks.default)) & (F.col("size") > 0))
        visible = listing.filter(~F.col("path").substr(F.lit(len(source)), F.length("path")).rlike("/[_.]"))
        fresh = visible.join(marks.loaded(table), ["path", "modified"], "left_anti")
        found = marks.add_files(table, fresh, load)
        sums = found.agg(F.count(F.lit(1)).alias("n"), F.max("modified").alias("newest")).first()
        since = marks.get(table)
        if not sums["n"]:
            return since
        reads = -(-sums["n"] // files_per_read)
        for i in range(reads):
            part = found.filter(F.pmod(F.xxhash64("path"), F.lit(reads)) == i).select("path")
            paths = [r["path"] for r in part.toLocalIterator()]
            if not paths:
                continue
            raw = scan_json(spark, plain_paths(paths), schema)
            stamp = F.col("_metadata.file_modification_time") if loaded_at is None else F.lit(loaded_at)
            rows = stamp_load(raw, stamp).withColumnsRenamed(dict(rename or {})).withColumn("LOAD", F.lit(load))
            write_table(rows, target, [*partition_by, "LOAD"], mode="append", files=files)
        newest = max(since, sums["newest"])
        marks.advance(table, newest, load)
        return newest


def read_loaded(spark: SparkSession, table: str, target: str, marks: Watermark) -> DataFrame:
    """Rows of the committed loads of a table."""
    rows = spark.read.parquet(target)
    return rows.join(marks.loads(table).withColumnRenamed("load", "LOAD"), "LOAD", "left_semi").drop("LOAD")
