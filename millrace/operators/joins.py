"""Join shapes. No hint forces a broadcast here: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges. Joins that bring one row per key back to a
table whose keys may be very uneven are salted."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Parts into which the rows of one key are cut where a key may hold a large share of a table.
SALTS = 8


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", salts: int = 1) -> DataFrame:
    """Equi-join on equal names in which null keys match each other; the right side's keys are dropped.

    With ``salts`` over 1 the rows of a key are spread over that many join partitions, by a hash of the row so that a
    repeated task spreads them alike, and the right side is repeated for each. It is meant for a right side with one
    short row per key. Not for right or full joins, which would repeat unmatched rows.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if salts > 1:
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"a {how} join cannot be salted")
        hashable = [c for c, kind in left.dtypes if "map<" not in kind]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
        renamed = renamed.withColumn("_r__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = [*keys, "_salt"]
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop("_salt", *[f"_r_{k}" for k in keys])


def left_join_all(spine: DataFrame, parts: Iterable[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Spine left-joined with many measure tables, each on its own keys.

    Every measure table has to be unique on its keys: ``duplicate_keys`` shows the rows that would multiply.
    Tables that share keys are joined one after the other, so Spark reuses one partitioning of the spine for them.
    """
    out = spine
    for df, keys in sorted(parts, key=lambda p: tuple(p[1])):
        out = out.join(df, list(keys), "left")
    return out


def cross_spine(items: DataFrame, months: Sequence[date], labels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Every item for every month and every label value.

    The months and labels are literals, so each item row is expanded in place: no join and no shuffle.
    """
    out = items.select("*", F.explode(F.array(*[F.lit(m) for m in months])).alias("month"))
    for name, values in (labels or {}).items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return out


def append_missing(base: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base plus the rows of ``other`` whose key the base lacks; missing columns are null."""
    return base.unionByName(other.join(base.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def except_by_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_anti")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Keys only in ``a`` and keys only in ``b``."""
    left, right = a.select(*keys).distinct(), b.select(*keys).distinct()
    return left.join(right, list(keys), "left_anti"), right.join(left, list(keys), "left_anti")


def exclude_ids(df: DataFrame, key: str, deny: DataFrame) -> DataFrame:
    """Rows whose id is not in the deny table; rows without id stay."""
    return df.join(deny.select(key), key, "left_anti")


def texts_by_language(
    df: DataFrame, keys: Sequence[str], language: str, text: str, variants: Mapping[str, str]
) -> DataFrame:
    """One row per key with one column per language code, in one scan.

    ``variants`` maps a language code to its output column; the greatest text wins when a code repeats.
    """
    aggs = [F.max(F.when(F.col(language) == code, F.col(text))).alias(name) for code, name in variants.items()]
    return df.groupBy(*keys).agg(*aggs)


def lookup_with_fallback(
    df: DataFrame,
    exact: DataFrame,
    exact_keys: Sequence[str],
    general: DataFrame,
    general_keys: Sequence[str],
    value: str,
    default: Column | None = None,
) -> DataFrame:
    """Value of the exact key, else of the general key, else ``default``. Both lookups are unique on their keys."""
    first = exact.select(*exact_keys, F.col(value).alias("_exact"))
    second = general.select(*general_keys, F.col(value).alias("_general"))
    found = df.join(first, list(exact_keys), "left").join(second, list(general_keys), "left")
    options = [F.col("_exact"), F.col("_general"), *([default] if default is not None else [])]
    return found.withColumn(value, F.coalesce(*options)).drop("_exact", "_general")


def enrich_geography(df: DataFrame, nation: DataFrame, nation_key: str, region: DataFrame, region_key: str) -> DataFrame:
    """Country, then region of each row, through two code tables."""
    return df.join(nation, nation_key, "left").join(region, region_key, "left")


def split_conditions(
    df: DataFrame, keys: Sequence[str], unit: str, value: str, percent: str = "%"
) -> DataFrame:
    """One row per key with the amount and the percent condition side by side.

    One conditional aggregate instead of splitting and joining the table with itself; rows whose keys hold nulls
    are kept (a self-join on equality would lose them).
    """
    is_percent = F.col(unit).eqNullSafe(F.lit(percent))
    return df.groupBy(*keys).agg(
        F.max(F.when(~is_percent, F.col(unit))).alias("currency"),
        F.sum(F.when(~is_percent, F.col(value))).alias("amount"),
        F.sum(F.when(is_percent, F.col(value))).alias("percent"),
    )
