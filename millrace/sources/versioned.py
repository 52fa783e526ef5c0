"""Tables at rest that change by files: merges, slice replacement and snapshots that touch only the files they must.

    data/LOAD=<id>/...      files of one change, never rewritten; a load that fails leaves files that no version names
    manifests/<id>          one row per live file: rows, smallest and largest key, partition values
    filters/<id>            a Bloom filter of the keys of every file of that change, as rows of 32,768 bits; all bits of
                            a key lie in one row
    increments/<id>         the newest rows of a merged increment, which a merge reads several times
    loads/<id>              which loads each file of that change holds rows of
    versions/0000000012.json  names the manifest; published by one rename that replaces nothing

A reader keeps the version it was opened with, whatever is published later. Two changes of one version cannot both be
published: the second one fails and may be tried again.

A merge finds the files that may hold a key of the increment: the key must lie between the file's smallest and largest
key and pass its filter. Only these are read and written again. Files are written in ranges of the key, so keys that
come in the order of time, as document numbers do, hit few files. The driver sees one row per file, as Spark's own file
listing does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import match
from millrace.operators.skew import match_skewed
from millrace.operators.snapshots import Order, latest_by_key
from millrace.sources.shared_files import names, read_text, write_new

# Bits of a file's filter per row, and bits that each key sets: about one key in 400 passes a filter by mistake.
BITS_PER_KEY = 16
PROBES = 4
BITMAP = 32_768  # bits of one row of a filter, fixed by bitmap_construct_agg
# Ranges into which the smallest keys of the files are cut to find the files of a key.
CELLS = 256


class VersionedTable:
    """A table at ``path``; ``keys`` identify a row.

    With ``load_time``, the column that tells loads apart, and ``load_group``, columns by which loads are chosen, the
    table keeps an index of its loads for ``snapshot``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        *,
        partition_by: Sequence[str] = (),
        load_time: str | None = None,
        load_group: Sequence[str] = (),
        rows_per_file: int = 1_000_000,
    ) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.partition_by, self.rows_per_file = list(partition_by), rows_per_file
        self.load_time, self.load_group = load_time, list(load_group)

    # Versions

    def version(self) -> int:
        """Newest version; 0 before the first."""
        return max((int(n.partition(".")[0]) for n in names(self.spark, f"{self.path}/versions")), default=0)

    def _entry(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/versions/{version:010d}.json"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """Live files of a version: file, change, partition values, rows, smallest (lo) and largest key (hi)."""
        return self.spark.read.parquet(f"{self.path}/manifests/{self._entry(version or self.version())['manifest']}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default. The rows stay the same when later versions are published."""
        version = version or self.version()
        return self._read(self.manifest(version), self._schema(version))

    def _schema(self, version: int) -> T.StructType:
        return T.StructType.fromJson(self._entry(version)["schema"])

    def _read(self, files: DataFrame, schema: T.StructType, name: str | None = None) -> DataFrame:
        """Rows of the listed files, on request with their file (one name per file to the driver, which plans the scan)."""
        paths = [f"{self.path}/data/{unquote(r['file'])}" for r in files.select("file").toLocalIterator()]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(name, F.lit(None).cast("string")) if name else empty
        full = T.StructType([*schema.fields, T.StructField("LOAD", T.StringType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*schema.names, *([_file().alias(name)] if name else []))

    # Changes

    def _write(self, rows: DataFrame, change: str) -> DataFrame:
        """Write the files of a change and describe them."""
        spread = rows.repartitionByRange(*[F.col(c) for c in [*self.partition_by, *self.keys]]).sortWithinPartitions(*self.partition_by, *self.keys)
        writer = spread.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        folder = f"{self.path}/data/LOAD={change}"
        writer.parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder).withColumn("file", _file())
        key = F.struct(*self.keys)
        stats = [F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi")]
        described = written.groupBy("file", *self.partition_by).agg(*stats).withColumn("change", F.lit(change))
        files = self._kept(described.select("file", "change", *self.partition_by, "rows", "lo", "hi"), f"manifests/{change}-new")
        self._write_filters(written, files, change)
        if self.load_time:
            self._kept(written.select("file", *self.load_group, self.load_time).distinct(), f"loads/{change}")
        return files

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def _write_filters(self, written: DataFrame, files: DataFrame, change: str) -> None:
        # Grouped by one number for file and row: sorting the bits by names of files, which begin alike, is slow. Two
        # rows with the same number would share their bits, which keeps no file out that holds a key.
        row = F.xxhash64("file", "part").alias("row")
        sized = files.select("file", _parts("rows").alias("parts"))
        keys = written.select("file", *self.keys).join(sized, "file").withColumn("part", _part(self.keys, F.col("parts")))
        bits = keys.select(row, F.explode(F.array(*_probes(self.keys))).alias("bit"))
        rows = bits.groupBy("row").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
        named = sized.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).select("file", "part", row)
        rows.join(named, "row").select("file", "part", "bits").write.mode("overwrite").parquet(f"{self.path}/filters/{change}")

    def _publish(self, based_on: int, files: DataFrame, schema: T.StructType, change: str, **facts) -> int:
        files.write.mode("overwrite").parquet(f"{self.path}/manifests/{change}")
        entry = {"version": based_on + 1, "manifest": change, "schema": schema.jsonValue(), **facts}
        write_new(self.spark, f"{self.path}/versions/{based_on + 1:010d}.json", json.dumps(entry))
        return based_on + 1

    def append(self, rows: DataFrame, load: str | None = None) -> int:
        """Add rows as they are and return the new version.

        ``load`` names the load: one that is in the table already is not added again, and a load that died is written
        anew, so that a job can be repeated until it succeeds.
        """
        version = self.version()
        if load is not None and load in self.loads():
            return version
        change = _new(load)
        files = self._write(rows, change)
        schema = self._schema(version) if version else rows.schema
        live = self.manifest(version).unionByName(files) if version else files
        return self._publish(version, live, schema, change, load=load)

    def loads(self) -> set[str]:
        """Names of the loads that are in the table (one name per load)."""
        entries = (self._entry(v) for v in range(1, self.version() + 1))
        return {e["load"] for e in entries if e.get("load")}

    def merge(self, increment: DataFrame, order_by: Sequence[Order], load: str | None = None) -> int:
        """Newest version of every key of table and increment, by ``order_by`` as in ``latest_by_key``.

        Files without a key of the increment stay as they are. A column that only the increment has is null in older
        rows. Returns the new version.
        """
        version = self.version()
        if load is not None and load in self.loads():
            return version
        change = _new(load)
        if not version:
            files = self._write(latest_by_key(increment, self.keys, order_by), change)
            return self._publish(0, files, increment.schema, change, load=load, rewritten=0)
        schema, live = self._schema(version), self.manifest(version)
        fresh = self._kept(latest_by_key(increment, self.keys, order_by), f"increments/{change}")
        touched = self._kept(self.files_of(fresh, version), f"manifests/{change}-touched")
        old = self._read(touched, schema)
        merged = latest_by_key(old.unionByName(fresh, allowMissingColumns=True), self.keys, order_by)
        files = self._write(merged, change)
        kept = live.join(touched, "file", "left_anti").select(*files.columns)
        return self._publish(version, kept.unionByName(files), merged.schema, change, load=load, rewritten=touched.count())

    def replace(self, rows: DataFrame, load: str | None = None) -> int:
        """Replace all rows and return the new version."""
        version = self.version()
        if load is not None and load in self.loads():
            return version
        change = _new(load)
        return self._publish(version, self._write(rows, change), rows.schema, change, load=load)

    def replace_slice(self, new_rows: DataFrame, outside: Column, load: str | None = None) -> int:
        """Replace the rows for which ``outside`` is not true by ``new_rows``, in one visible step.

        Only files with such rows are written again. A reader of an older version keeps seeing the old slice.
        """
        version, change = self.version(), _new(load)
        schema, live = self._schema(version), self.manifest(version)
        stays = F.coalesce(outside, F.lit(False))
        rows = self._read(live, schema, "file")
        hit = self._kept(rows.filter(~stays).select("file").distinct(), f"manifests/{change}-touched")
        rest = self._read(hit, schema).filter(stays)
        files = self._write(rest.unionByName(new_rows.select(*schema.names)), change)
        kept = live.join(hit, "file", "left_anti").select(*files.columns)
        return self._publish(version, kept.unionByName(files), schema, change, load=load, rewritten=hit.count())

    # Index

    def files_of(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """(file) of a version that may hold a key of ``rows``: no file that holds one is missing."""
        live = self.manifest(version)
        bounds = self._bounds(live)
        key, low, high = F.col("_key"), F.col("_low"), F.col("_high")
        keys = rows.select(*self.keys).distinct().withColumn("_key", F.struct(*self.keys))
        ranges = live.select(F.col("file").alias("_file"), F.col("lo").alias("_low"), F.col("hi").alias("_high"), _parts("rows").alias("_parts"))
        ranges = ranges.withColumn("_cell", F.explode(F.sequence(_cell(low, bounds), _cell(high, bounds))))
        near = keys.withColumn("_cell", _cell(key, bounds)).join(ranges, "_cell").filter((key >= low) & (key <= high))
        # One row per key and file: the key's bits are asked of one row of the file's filter.
        bits = [p.alias(f"_bit{i}") for i, p in enumerate(_probes(self.keys))]
        probes = near.select(F.col("_file").alias("file"), _part(self.keys, F.col("_parts")).alias("part"), *bits)
        met = probes.join(self._of_changes(live, "filters"), ["file", "part"])
        for i in range(PROBES):
            met = met.filter(_is_set(F.col("bits"), F.col(f"_bit{i}")))
        return met.select("file").distinct()

    def _of_changes(self, live: DataFrame, what: str) -> DataFrame:
        """Index rows of the changes that still have live files (one name per change to the driver)."""
        changes = [r["change"] for r in live.select("change").distinct().toLocalIterator()]
        return self.spark.read.parquet(*[f"{self.path}/{what}/{c}" for c in sorted(changes)])

    def _bounds(self, live: DataFrame) -> list:
        """Fewer than ``CELLS`` rising keys, spread evenly over the files' smallest keys."""
        lows = [r["lo"] for r in live.select("lo").distinct().orderBy("lo").toLocalIterator()]  # one per file
        step = len(lows) // CELLS + 1
        return lows[step::step]

    # Snapshots

    def snapshot_files(self, group: Sequence[str | Column], pick: str = "max", version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The chosen loads (group as g0, g1, ..., load time as ts) and the files (file) that hold rows of them."""
        live = self.manifest(version)
        index = self._of_changes(live, "loads").join(live.select("file"), "file", "left_semi")
        named = _groups(index, group).withColumn("ts", F.col(self.load_time))
        names_of = [f"g{i}" for i in range(len(group))]
        best = F.max("ts") if pick == "max" else F.min("ts")
        chosen = named.groupBy(*names_of).agg(best.alias("ts"))
        return chosen, match(named, chosen, [*names_of, "ts"], "left_semi").select("file").distinct()

    def snapshot(self, group: Sequence[str | Column] = (), pick: str = "max", version: int | None = None) -> DataFrame:
        """All rows of the newest (or oldest) load of each group; of the whole table without groups.

        A group is a column of ``load_group`` or an expression on it and the load time. The loads are chosen from the
        index, so that files without a chosen load are not opened, however many loads the table holds.
        """
        version = version or self.version()
        chosen, files = self.snapshot_files(group, pick, version)
        rows = _groups(self._read(files, self._schema(version)), group).withColumn("ts", F.col(self.load_time))
        keys = [*[f"g{i}" for i in range(len(group))], "ts"]
        return match_skewed(rows, chosen, keys, "left_semi").drop(*keys)


def _new(load: str | None) -> str:
    return f"{load}-{uuid.uuid4().hex[:8]}" if load else uuid.uuid4().hex


def _file() -> Column:
    return F.concat(F.lit("LOAD="), F.substring_index("_metadata.file_path", "/data/LOAD=", -1))


def _groups(df: DataFrame, group: Sequence[str | Column]) -> DataFrame:
    return df.withColumns({f"g{i}": F.col(g) if isinstance(g, str) else g for i, g in enumerate(group)})


def _parts(rows: str) -> Column:
    """Rows of the filter of a file with so many rows."""
    return F.ceil(F.col(rows) * BITS_PER_KEY / BITMAP).cast("long")


def _part(keys: Sequence[str], parts: Column) -> Column:
    """The row of a filter of so many that holds the bits of a key."""
    return F.pmod(F.xxhash64(F.lit(PROBES), *keys), parts)


def _probes(keys: Sequence[str]) -> list[Column]:
    """Bits that a key sets in its row of a filter, cut from one hash."""
    width = BITMAP.bit_length() - 1
    h = F.xxhash64(*keys)
    return [F.shiftrightunsigned(h, i * width).bitwiseAND(F.lit(BITMAP - 1).cast("long")) for i in range(PROBES)]


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.ascii(F.decode(F.substring(bits, F.shiftright(bit, 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def _cell(key: Column, bounds: list) -> Column:
    """Number of bounds up to a key, found by halving."""
    if not bounds:
        return F.lit(0)
    at = [F.struct(*[F.lit(v).alias(n) for n, v in b.asDict().items()]) for b in bounds]

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < at[mid], halve(low, mid)).otherwise(halve(mid + 1, high))

    return halve(0, len(at))
