"""File scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.columns import upper_all

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All-text schema, the form in which ERP extracts arrive."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def json_reader(reader, schema: T.StructType, multiline: bool, primitives_as_string: bool, keep_corrupt: bool):
    """JSON options shared by batch and streaming reads."""
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
        .option("primitivesAsString", primitives_as_string)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
    )


def scan_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    multiline: bool = False,
    primitives_as_string: bool = False,
    modified_after: datetime | None = None,
    quarantine: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """JSON files below a path or glob, read with a fixed schema.

    ``modified_after`` keeps files strictly newer than a mark. With ``quarantine`` the result is a pair: the rows
    that parse, and the unreadable records with their file, so that a broken file never stops a load.
    """
    reader = json_reader(spark.read, schema, multiline, primitives_as_string, quarantine)
    if modified_after is not None:
        # Whole seconds here prune the file listing; the exact mark is tested below on the file's own time.
        mark = modified_after.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", mark).option("timeZone", "UTC")
    df = reader.json(path if isinstance(path, str) else list(path))
    if modified_after is not None:
        df = df.filter(F.col("_metadata.file_modification_time") > F.lit(modified_after))
    if not quarantine:
        return df
    bad = F.col(CORRUPT).isNotNull()
    good = df.filter(~bad).drop(CORRUPT)
    return good, df.filter(bad).select("*", F.col("_metadata.file_path").alias("source_file"))


def scan_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, where: Column | None = None
) -> DataFrame:
    """Parquet scan; the predicate is applied right at the scan so that it is pushed down."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if where is None else df.filter(where)


def scan_dimension(
    spark: SparkSession, path: str, columns: Sequence[str], *, fmt: str = "csv", upper: bool = False
) -> DataFrame:
    """Small code table from CSV (with header) or Parquet; listed columns only, text upper-cased on request."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path).select(*columns)
    return upper_all(df) if upper else df


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Table written out in code: a measure map, a cost row, a list of concepts."""
    return spark.createDataFrame(list(rows), schema)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or an empty one with the schema when the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """File each row was read from; call it directly on a scan."""
    return df.select("*", F.col("_metadata.file_path").alias(name))
