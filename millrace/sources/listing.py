"""Recursive file listing as a table.

Spark's file sources skip empty files and list on the driver, so an audit of files needs a listing of its own. It goes
in rounds: every task lists some folders and the folders below them, up to a bound, and what is left is dealt anew to
all tasks. So a tree that hangs on one folder spreads like any other, and a deep chain does not take a round per level.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.snapshots import top_n
from millrace.sources.workspace import new_path

# Folders that a task lists before it hands the rest back.
FOLDERS = 256
ROWS = pa.schema(
    [
        ("path", pa.string()),
        ("name", pa.string()),
        ("size", pa.int64()),
        ("modified", pa.timestamp("us", tz="UTC")),
        ("folder", pa.bool_()),
    ]
)


def open_folder(root: str):
    """Arrow file system, path of a folder in it, and what to put before such paths to have Spark's form again."""
    from pyarrow import fs

    if root.startswith("file:/") and not root.startswith("file://"):
        root = root.replace("file:", "file://", 1)
    system, base = fs.FileSystem.from_uri(root)
    front = root.rstrip("/")
    front = front[: len(front) - len(base.rstrip("/"))] if front.endswith(base.rstrip("/")) else ""
    return system, base, front


def _walk(batches: Iterator[pa.RecordBatch], root: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of the entries below the folders of the batches; folders that are still to be listed are marked."""
    from pyarrow import fs

    system, _, front = open_folder(root)
    listed = 0
    for batch in batches:
        queue = deque(batch.column("path").to_pylist())
        while queue:
            if listed >= most:
                rest = [{"path": p, "name": "", "size": None, "modified": None, "folder": True} for p in queue]
                yield pa.RecordBatch.from_pylist(rest, ROWS)
                break
            listed += 1
            rows = []
            for e in system.get_file_info(fs.FileSelector(queue.popleft()[len(front):])):
                if e.is_file:
                    micros = e.mtime_ns // 1000
                    rows.append({"path": front + e.path, "name": e.base_name, "size": e.size, "modified": micros, "folder": False})
                else:
                    queue.append(front + e.path)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ROWS)


def list_files(spark: SparkSession, root: str, folders_per_task: int = FOLDERS) -> DataFrame:
    """(path, name, size, modified) of every file below a folder: a local path or any URI that Arrow's file systems know.

    The listing is taken once, when this is called, and kept in the shared folder.
    """
    _, base, front = open_folder(root)
    kept, rounds = new_path(spark, "listing"), 0
    schema = "path string, name string, size bigint, modified timestamp, folder boolean"
    frontier, count = spark.createDataFrame([(front + base,)], "path string"), 1
    while count:
        dealt = frontier.repartition(min(count, 8 * spark.sparkContext.defaultParallelism))

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _walk(batches, root, folders_per_task)

        dealt.mapInArrow(walk, schema).write.parquet(f"{kept}/round={rounds}")
        frontier = spark.read.schema(schema).parquet(f"{kept}/round={rounds}").filter("folder").select("path")
        count, rounds = frontier.count(), rounds + 1
    return spark.read.schema(schema).parquet(*[f"{kept}/round={i}" for i in range(rounds)]).filter("not folder").drop("folder")


def new_files(spark: SparkSession, root: str, since: datetime) -> DataFrame:
    """Files modified strictly after a mark."""
    return list_files(spark, root).filter(F.col("modified") > F.lit(since))


def zero_byte_files(spark: SparkSession, root: str, as_of: date | None = None, within_days: int | None = 2) -> DataFrame:
    """Empty files, those modified in the last ``within_days`` days before ``as_of`` (all ages with ``None``)."""
    empty = list_files(spark, root).filter(F.col("size") == 0)
    if within_days is None or as_of is None:
        return empty
    return empty.filter(F.col("modified").cast("date") >= F.lit(as_of - timedelta(days=within_days)))


def path_part(n: int, path: str = "path") -> Column:
    """The ``n``-th part of a path from its end: 1 is the file, 2 the folder it lies in; null beyond the root."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= n, F.element_at(parts, -n))


def recent_files(files: DataFrame, keys: Sequence[str], n: int = 2) -> DataFrame:
    """Newest ``n`` files per key, from a listing with the key columns added."""
    return top_n(files, keys, ["modified", "path"], n)
