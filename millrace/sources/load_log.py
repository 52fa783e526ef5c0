"""Append-only log of load marks per table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.scans import scan_or_empty

LOG_SCHEMA = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("last_modified", T.TimestampType()), T.StructField("load", T.StringType())]
)
FILE_SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in (("table", T.StringType()), ("path", T.StringType()), ("modified", T.TimestampType()), ("load", T.StringType()))]
)


def latest_marks(log: DataFrame, table: str = "table", ts: str = "last_modified") -> DataFrame:
    """Newest mark per table."""
    return log.groupBy(table).agg(F.max(ts).alias(ts))


class Watermark:
    """Load marks kept at ``path``; a table without a mark starts at ``default``. Loaded files are kept beside it.

    A load is committed by its row in the log, the last thing it writes: files and rows of a load without one do not
    count.
    """

    def __init__(self, spark: SparkSession, path: str, default: datetime) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.files = self.path + "_files"
        self.leases = self.path + "_leases"
        self.default = default

    def log(self) -> DataFrame:
        return scan_or_empty(self.spark, self.path, LOG_SCHEMA)

    def get(self, table: str) -> datetime:
        """Newest mark of one table (one value to the driver)."""
        row = self.log().filter(F.col("table") == table).agg(F.max("last_modified").alias("mark")).first()
        return row["mark"] or self.default

    def advance(self, table: str, mark: datetime, load: str | None = None) -> None:
        """Append a mark, and with it commit a load; marks never move back because ``get`` takes the newest."""
        row = self.spark.createDataFrame([(table, mark, load)], LOG_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def loads(self, table: str) -> DataFrame:
        """(load) of every committed load."""
        return self.log().filter((F.col("table") == table) & F.col("load").isNotNull()).select("load").distinct()

    def loaded(self, table: str) -> DataFrame:
        """Path and modification time of every file that a committed load took."""
        files = scan_or_empty(self.spark, self.files, FILE_SCHEMA).filter(F.col("table") == table)
        return files.join(self.loads(table), "load", "left_semi").select("path", "modified")

    def add_files(self, table: str, files: DataFrame, load: str) -> DataFrame:
        """Write down the files (path, modified) of a load, and give them back as written."""
        path = f"{self.files}/part={load}"
        rows = files.select(F.lit(table).alias("table"), "path", "modified", F.lit(load).alias("load"))
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(FILE_SCHEMA).parquet(path)
