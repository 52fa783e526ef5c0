"""Context-triggered piecewise hashing: document fingerprints that change only where the text does.

A rolling hash over seven bytes decides where a piece ends, so boundaries move with the content. Each piece gives one
symbol. A fingerprint is ``block:symbols:symbols`` with the pieces at a block size and at its double; the block size
doubles with the length of the text and is halved while there are too few pieces. The last symbol stands for the whole
rest of the text. Two fingerprints are compared by the edit distance (insertions and deletions) of their symbols where
a block size of one occurs in the other; otherwise, and where they share no run of symbols, their likeness is 0.

Hashes of all texts of a batch are worked out together in numpy. Null text counts as empty; the fingerprint of an
empty text is ``3::``, and equal fingerprints have likeness 1.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import quantiles, with_small_batches

WINDOW = 7
SMALLEST = 3
LENGTH = 64
#: Symbols, by their value.
SYMBOLS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Odd multiplier of the piece hash and its inverse modulo 2**64, and the mixer of its bits.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
MIXER = np.uint64(0xD6E8FEB86659FD93)
#: Bytes hashed together, so that the arrays stay in the cache.
CHUNK = 1 << 19
#: Longest run of one symbol that a comparison sees.
RUN = re.compile(r"(.)\1{3,}")


def _rolling(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte of ``data``; the first WINDOW bytes only warm it up."""
    x = data.astype(np.uint32)
    total, mixed = np.zeros(len(x) - WINDOW, np.uint32), np.zeros(len(x) - WINDOW, np.uint32)
    for k in range(WINDOW):
        back = x[WINDOW - k : len(x) - k]
        total += back * np.uint32(WINDOW + 1 - k)  # the plain sum and the one weighted by age
        mixed ^= back << np.uint32(5 * k)
    return total + mixed


def _symbols(ends: np.ndarray, sums: np.ndarray, inverse: np.ndarray, size: int, most: int) -> bytes:
    """Symbols of the pieces that end after the given positions; the last takes the rest of the text."""
    ends = ends[: most - 1] + 1
    if not len(ends) or ends[-1] < size:
        ends = np.append(ends, size)
    starts = np.append(0, ends[:-1])
    pieces = (sums[ends] - sums[starts]) * inverse[starts]
    pieces = (pieces ^ (pieces >> np.uint64(29))) * MIXER
    return SYMBOLS[(pieces >> np.uint64(58)).astype(np.intp)].tobytes()


_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < size:
        n = max(size, CHUNK)
        for name, factor in (("up", FACTOR), ("down", INVERSE)):
            _POWERS[name] = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, factor, np.uint64)))
    return _POWERS["up"], _POWERS["down"]


def fingerprint_text(text: bytes) -> str:
    """Fingerprint of one UTF-8 text."""
    return fingerprint_texts([text])[0]


def fingerprint_texts(texts: list[bytes]) -> list[str]:
    """Fingerprints of UTF-8 texts, worked out together."""
    out: list[str] = []
    group: list[bytes] = []
    held = 0
    for text in texts:
        if group and held + len(text) > CHUNK:
            out.extend(_group(group))
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        out.extend(_group(group))
    return out


def _group(texts: list[bytes]) -> list[str]:
    front = bytes(WINDOW)
    hashes = _rolling(np.frombuffer(front + front.join(texts), np.uint8))
    out, at = [], 0
    for text in texts:
        n = len(text)
        if not n:
            out.append(f"{SMALLEST}::")
        else:
            own = hashes[at : at + n]
            up, down = _powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
            block = SMALLEST
            while block * LENGTH < n:
                block *= 2
            ends = np.flatnonzero(own % np.uint32(block) == block - 1)
            while len(ends) < LENGTH // 2 - 1 and block > SMALLEST:
                block //= 2
                ends = np.flatnonzero(own % np.uint32(block) == block - 1)
            wide = ends[own[ends] % np.uint32(2 * block) == 2 * block - 1]
            parts = [_symbols(e, sums, down, n, most).decode() for e, most in ((ends, LENGTH), (wide, LENGTH // 2))]
            out.append(f"{block}:{parts[0]}:{parts[1]}")
        at += n + WINDOW
    return out


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def symbol_likeness(a: str, b: str) -> float:
    """1 less the edit distance as a share of both lengths; 0 where the symbols share no run."""
    if a == b:
        return 1.0
    a, b = RUN.sub(r"\1\1\1", a), RUN.sub(r"\1\1\1", b)
    run = max(1, min(3, min(len(a), len(b)) // 3))
    if len(b) < run or len(a) < run or {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness_of(first: str, second: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if first == second:
        return 1.0
    block, narrow, wide = first.split(":")
    block2, narrow2, wide2 = second.split(":")
    if not narrow or not narrow2:
        return 0.0
    size, size2 = int(block), int(block2)
    if size == size2:
        return max(symbol_likeness(narrow, narrow2), symbol_likeness(wide, wide2))
    if size == 2 * size2:
        return symbol_likeness(narrow, wide2)
    if 2 * size == size2:
        return symbol_likeness(wide, narrow2)
    return 0.0


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprint_texts([t or b"" for t in texts]), dtype=object)

    return of(text.cast("binary"))


def likeness(first: Column, second: Column) -> Column:
    """Likeness of two columns of fingerprints."""

    @F.pandas_udf("double")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness_of(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return of(first, second)


def edited_by_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row beside an edit of it and beside its neighbour, in descending order of id.

    The edit replaces the last third of the text by as much of the front of the next text (after the last row: the
    first). Returns (id, n_chars, edited, fingerprint, edited_fingerprint, next_fingerprint). Rows without an id come
    last; rows with equal ids follow each other by text.

    Ranges of ids are cut at their quantiles. A range needs one row of another: the first of the range below. Those
    rows, one per range, are sent along, so the texts are shuffled once and no window spans the table.
    """
    spark = docs.sparkSession
    with_small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = np.array(quantiles(rows, "id", int(spark.conf.get("spark.sql.shuffle.partitions"))), "int64")

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.zeros(len(ids), "int32")
        at[known] = np.searchsorted(bounds, ids[known].to_numpy("int64"), "left")
        return pd.Series(at)

    rows = rows.withColumn("part", range_of("id"))
    # One row per range reaches the driver.
    first = {r["part"]: r["id"] for r in rows.groupBy("part").agg(F.max("id").alias("id")).collect()}
    order = sorted(first)
    route = [(first[p], p, order[(i + 1) % len(order)]) for i, p in enumerate(order)]
    heads = F.broadcast(spark.createDataFrame(route, "head long, head_part int, target int"))
    guests = rows.join(heads, F.col("id").eqNullSafe(F.col("head")) & (F.col("part") == F.col("head_part")))
    guests = guests.groupBy("id", "target").agg(F.min("text").alias("text"))
    both = rows.select("part", F.lit(False).alias("guest"), "id", "text").union(guests.select("target", F.lit(True), "id", "text"))
    dealt = both.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("guest", F.desc_nulls_last("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edit(batches, id_col)

    return dealt.mapInArrow(run, f"`{id_col}` long, n_chars long, edited string, fingerprint string, edited_fingerprint string, next_fingerprint string")


def _edit(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    """Rows in order, the last of them a guest: each with the one after it."""
    held: list[tuple] = []  # (id, text, fingerprint) of the last row seen
    for batch in batches:
        ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
        rows = held + list(zip(ids, texts, fingerprint_texts([t.encode() for t in texts]), strict=True))
        if not rows:
            continue
        edited = []
        for (_, text, _), (_, after, _) in itertools.pairwise(rows):
            third = len(text) // 3
            edited.append(text[: len(text) - third] + after[:third])
        held = rows[-1:]
        if edited:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows[:-1]], pa.int64()),
                    pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
                    pa.array(edited, pa.string()),
                    pa.array([r[2] for r in rows[:-1]], pa.string()),
                    pa.array(fingerprint_texts([t.encode() for t in edited]), pa.string()),
                    pa.array([r[2] for r in rows[1:]], pa.string()),
                ],
                [id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint"],
            )
