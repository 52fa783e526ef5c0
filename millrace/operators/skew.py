"""Keys that hold a large share of a table, found by a mergeable sketch, and joins that cut just these into pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is cut so that no piece is larger than this part of one join partition's even share.
FINENESS = 8
# Sketches that are merged side by side before the last merge.
MERGES = 64


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key; null keys are a key like any other."""
    return F.xxhash64(*[F.struct(F.col(k).isNull(), F.col(k)) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(hash, pieces) of the keys that hold over 1 / (8 x ``partitions``) of the rows.

    A frequent-items sketch of bounded size runs in every task, and the sketches are merged in two steps, so the work
    does not grow with the number of distinct keys. Its counts are upper bounds: no heavy key is missed, and a key
    reported by mistake costs a few repeated rows. There are at most 8 x ``partitions`` rows. Only the key columns are
    read. ``partitions`` is the session's number of shuffle partitions by default.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = FINENESS * parts
    tracked = max(64, 1 << (4 * most - 1).bit_length())
    spread = df.select(key_hash(keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("m"))
    sketches = spread.groupBy("m").agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"), F.count(F.lit(1)).alias("n"))
    # Grouped by a constant, so that tasks without rows give no sketch, which could not be merged.
    whole = sketches.groupBy(F.lit(0).alias("_")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"), F.sum("n").alias("n"))
    top = whole.select("n", F.explode(F.expr(f"approx_top_k_estimate(s, {min(most, tracked)})")).alias("t"))
    share = F.col("t.count") * most / F.col("n")
    return top.filter(share > 1).select(F.col("t.item").alias("hash"), F.ceil(share).cast("int").alias("pieces"))


def match_skewed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", partitions: int | None = None) -> DataFrame:
    """Equi-join on equal names, null keys matching each other, that survives keys with a large share of ``left``.

    Just the heavy keys of ``left`` are cut into pieces, by a hash of the row so that a repeated task cuts them alike,
    and just their rows of ``right`` are repeated, once for each piece. Meant for a ``right`` with one row, or a few,
    per key. Not for right or full joins, which would repeat unmatched rows. ``left`` is read twice, the first time by
    its keys alone.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join cannot be cut into pieces")
    heavy = heavy_keys(left, keys, partitions)
    mine = F.broadcast(heavy.withColumnsRenamed({"hash": "_hash", "pieces": "_pieces"}))  # 8 x partitions rows at most
    hashable = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    cut = left.withColumn("_h", key_hash(keys)).join(mine, F.col("_h") == F.col("_hash"), "left")
    cut = cut.withColumn("_piece", F.pmod(F.xxhash64(*hashable), F.coalesce("_pieces", F.lit(1))).cast("int")).drop("_h", "_hash", "_pieces")
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    theirs = named.withColumn("_r_h", key_hash([f"_r_{k}" for k in keys])).join(mine, F.col("_r_h") == F.col("_hash"), "left")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    theirs = theirs.withColumn("_r__piece", each).drop("_r_h", "_hash", "_pieces")
    on = cut["_piece"] == theirs["_r__piece"]
    for k in keys:
        on = on & cut[k].eqNullSafe(theirs[f"_r_{k}"])
    return cut.join(theirs, on, how).drop("_piece", "_r__piece", *[f"_r_{k}" for k in keys])
