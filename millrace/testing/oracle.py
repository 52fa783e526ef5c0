"""Side-by-side check of a Spark result and a DuckDB result, independent of row and column order."""

from __future__ import annotations

import glob
import hashlib
import os

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _canonical(table: pa.Table) -> list[str]:
    columns = {name: table.column(name).to_pylist() for name in sorted(table.column_names)}
    return sorted(map(repr, zip(*columns.values()))) if columns else []


def _types(table: pa.Table) -> dict[str, str]:
    out = {}
    for field in table.schema:
        kind = str(field.type).replace("large_string", "string")
        out[field.name] = kind
    return dict(sorted(out.items()))


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    """Row counts, column types and value hashes of both sides, and the first rows that differ."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    a, b = _canonical(ours), _canonical(theirs)
    digest = [hashlib.sha256("\n".join(rows).encode()).hexdigest() for rows in (a, b)]
    sa, sb = set(a), set(b)
    return {
        "rows": (len(a), len(b)),
        "types": (_types(ours), _types(theirs)),
        "ok": digest[0] == digest[1] and _types(ours) == _types(theirs),
        "hash_ok": digest[0] == digest[1],
        "only_ours": sorted(sa - sb)[:3],
        "only_theirs": sorted(sb - sa)[:3],
    }
