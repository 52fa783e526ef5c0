"""Stream of file arrivals: a file is new when its path and modification time together were not seen before.

Spark's own file source knows files by path alone, so a file delivered again under its old name adds nothing there. This
source puts what it finds into numbered batches, in the order of modification time and path, and writes each batch down
in ``log`` before Spark hears of it. The offset is the number of the last batch with the time and path of its last file;
the log is the set of files seen. A file that comes late with an older time is new like any other. After a crash the
same numbers hold the same files, so whatever is written under a batch's number can be written again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.sources.listing import open_folder

SCHEMA = "batch bigint, path string, size bigint, modified timestamp"
START = {"batch": 0, "modified": 0, "path": ""}


class ArrivalLog:
    """Numbered batches of (modified in nanoseconds, path, size), one file each, written once."""

    def __init__(self, folder: str) -> None:
        self.system, self.folder, _ = open_folder(folder)
        self.system.create_dir(self.folder, recursive=True)

    def numbers(self) -> list[int]:
        from pyarrow import fs

        found = (e.base_name for e in self.system.get_file_info(fs.FileSelector(self.folder)))
        return sorted(int(n.partition(".")[0]) for n in found if n.endswith(".json") and not n.startswith("."))

    def read(self, number: int) -> list[tuple[int, str, int]]:
        with self.system.open_input_stream(f"{self.folder}/{number:010d}.json") as source:
            return [tuple(f) for f in json.loads(source.read())]

    def write(self, number: int, files: Sequence[tuple[int, str, int]]) -> None:
        own = f"{self.folder}/.{number:010d}-{uuid.uuid4().hex}"
        with self.system.open_output_stream(own) as out:
            out.write(json.dumps(files).encode())
        self.system.move(own, f"{self.folder}/{number:010d}.json")


class Batch(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class ArrivalReader(DataSourceStreamReader):
    def __init__(self, root: str, log: str, most: int) -> None:
        self.root, self.log, self.most = root, log, most
        # Eight bytes of a hash for each file, so that millions of files take little memory.
        self.seen: set[bytes] = set()
        self.last = dict(START)

    def initialOffset(self) -> dict:
        return dict(START)

    def _catch_up(self, log: ArrivalLog) -> None:
        for number in log.numbers():
            if number > self.last["batch"]:
                files = log.read(number)
                self.seen.update(_mark(*f[:2]) for f in files)
                self.last = {"batch": number, "modified": files[-1][0], "path": files[-1][1]}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        log = ArrivalLog(self.log)
        self._catch_up(log)
        system, base, front = open_folder(self.root)
        found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        files = [(e.mtime_ns, front + e.path, e.size) for e in found if e.is_file and not _hidden(e.path[len(base):])]
        fresh = sorted(f for f in files if _mark(*f[:2]) not in self.seen)
        for i in range(0, len(fresh), self.most):
            log.write(self.last["batch"] + 1, fresh[i : i + self.most])
            self._catch_up(log)
        return dict(self.last)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Batch(n) for n in range(start["batch"] + 1, end["batch"] + 1)]

    def read(self, partition: Batch) -> Iterator[tuple]:
        for modified, path, size in ArrivalLog(self.log).read(partition.number):
            yield partition.number, path, size, datetime.fromtimestamp(modified / 1e9, tz=timezone.utc)


def _mark(modified: int, path: str) -> bytes:
    return hashlib.blake2b(f"{modified} {path}".encode(), digest_size=8).digest()


def _hidden(path: str) -> bool:
    """Whether Spark's readers pass over a path: a part begins with ``_`` or ``.``."""
    return any(p[:1] in ("_", ".") for p in path.split("/"))


class FileArrivals(DataSource):
    """``spark.readStream.format("file_arrivals")`` with options ``path``, ``log`` and ``filesPerBatch``."""

    @classmethod
    def name(cls) -> str:
        return "file_arrivals"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ArrivalReader:
        return ArrivalReader(self.options["path"], self.options["log"], int(self.options.get("filesPerBatch", 10_000)))


def arrivals(spark: SparkSession, root: str, log: str, files_per_batch: int = 10_000) -> DataFrame:
    """Stream of (batch, path, size, modified) of the files below ``root``; ``log`` belongs to one query alone."""
    spark.dataSource.register(FileArrivals)
    return spark.readStream.format("file_arrivals").option("log", log).option("filesPerBatch", files_per_batch).load(root)
