"""Packing of tokenized documents into sequences, shortest pack first over the length histogram.

Every document is cut into full pieces of the limit and one rest. Only the histogram of piece lengths (one row per
length) reaches the driver. Lengths are placed longest first: pieces of a length go to the open packs that are
shortest so far, a new pack is opened only where the piece does not fit into the shortest. Packs of equal content are
one run of sequence ids, so a step moves a whole run or splits one, however many documents stand behind it.
Packs that stay more than a little short at the end are laid end to end and cut anew at the limit, which cuts at most
one piece for each sequence made. The plan says, for each length, which ranks go to which run at which offset; pieces
are ranked within their length and joined to it. Ranks are counted in parts, so a length that holds a third of all pieces is no hot key.

Null text counts as empty and gives the end id alone. Rows may repeat; every row is packed by itself.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import memo, saved, with_small_batches
from millrace.llm.token_ids import WordTokenizer, id_type

#: Pieces of one length that are ranked together.
RANKED = 4096
#: A pack with more than this share of the limit free at the end is cut anew.
FREE = 1 / 64


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every row's ids, ``end_id`` included: (doc_id, doc_tokens, start, length, ids).

    ``ids`` holds unsigned little-endian integers, of 16 bits where the vocabulary allows and else of 32.
    """
    with_small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = memo(WordTokenizer, tokenizer_file)
        end, w = tokens.end(end_id), tokens.width
        for batch in batches:
            out: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode_all(texts, end), strict=True):
                n = len(ids) // w
                out.extend((doc_id, n, s, min(limit, n - s), ids[s * w : (s + limit) * w]) for s in range(0, n, limit))
            if out:
                a, b, c, d, e = zip(*out, strict=True)
                arrays = [pa.array(x, pa.int64()) for x in (a, b, c)] + [pa.array(d, pa.int32()), pa.array(e, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "doc_tokens", "start", "length", "ids"])

    return rows.mapInArrow(cut, "doc_id long, doc_tokens long, start long, length int, ids binary")


@dataclass
class Plan:
    """What goes where. ``steps``: for each length rows (first rank, first sequence id, offset), by rank.

    ``short``: runs that are cut anew, rows (first sequence id, sequences, tokens in each, place of the first in the
    row of all of them), by sequence id; the new sequences are numbered from ``sequences``.
    """

    limit: int
    steps: dict[int, np.ndarray]
    short: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence id and offset of pieces, as if sequences had no end; the end of a short one is cut later."""
        sequence, offset = np.zeros(len(rank), "int64"), np.zeros(len(rank), "int64")
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            runs = self.steps[int(n)]
            at = np.searchsorted(runs[:, 0], rank[rows], "right") - 1
            sequence[rows] = runs[at, 1] + rank[rows] - runs[at, 0]
            offset[rows] = runs[at, 2]
        if len(self.short):
            at = np.searchsorted(self.short[:, 0], sequence, "right") - 1
            first, count, used, start = self.short[np.maximum(at, 0)].T
            anew = (at >= 0) & (sequence < first + count)
            row = start + (sequence - first) * used + offset
            sequence = np.where(anew, self.sequences + row // self.limit, sequence)
            offset = np.where(anew, row % self.limit, offset)
        return sequence, offset


def plan(histogram: dict[int, int], limit: int) -> Plan:
    """Shortest pack first: place all pieces of a histogram of lengths, longest first."""
    steps: dict[int, np.ndarray] = {}
    runs: list[tuple[int, int, int]] = []  # open: (tokens so far, first sequence id, sequences)
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left, rank, taken = histogram[length], 0, []
        while left:
            if runs and runs[0][0] + length <= limit:
                used, first, count = heapq.heappop(runs)
            else:
                used, first, count = 0, sequences, left
                sequences += left
            now = min(left, count)
            taken.append((rank, first, used))
            if used + length < limit:
                heapq.heappush(runs, (used + length, first, now))
            if now < count:
                heapq.heappush(runs, (used, first + now, count - now))
            left -= now
            rank += now
        steps[length] = np.array(taken, "int64")
    short, row = [], 0
    for used, first, count in sorted((r for r in runs if r[0] < limit * (1 - FREE)), key=lambda r: r[1]):
        short.append((first, count, used, row))
        row += used * count
    return Plan(limit, steps, np.array(short, "int64").reshape(-1, 4), sequences)


def _ranked(cut: DataFrame, histogram: DataFrame) -> DataFrame:
    """(piece, length, rank): rank from 0 within the length."""
    parts = histogram.select("length", F.ceil(F.col("count") / RANKED).alias("parts"))
    dealt = cut.select("piece", "length").join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("piece"), "parts"))
    dealt = dealt.drop("parts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("piece")) - 1
    return dealt.withColumn("own", own).join(counts, ["length", "part"]).select("piece", "length", (F.col("first") + F.col("own")).alias("rank"))


def pack(cut: DataFrame, limit: int) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset`` there; some are cut once more."""
    spark = cut.sparkSession
    cut = saved(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    histogram = saved(cut.groupBy("length").count(), "lengths")
    # One row per length, limit rows at most.
    shared = spark.sparkContext.broadcast(plan({r["length"]: r["count"] for r in histogram.collect()}, limit))

    @F.pandas_udf("array<struct<skip int, length int, sequence_id long, offset int>>")
    def place(length: pd.Series, rank: pd.Series) -> pd.Series:
        sequence, offset = shared.value.place(length.to_numpy(), rank.to_numpy())
        out = []
        for n, s, o in zip(length.tolist(), sequence.tolist(), offset.tolist(), strict=True):
            fits = min(n, limit - o)
            part = {"skip": 0, "length": fits, "sequence_id": s, "offset": o}
            out.append([part] if fits == n else [part, {"skip": fits, "length": n - fits, "sequence_id": s + 1, "offset": 0}])
        return pd.Series(out)

    placed = _ranked(cut, histogram).select("piece", F.explode(place("length", "rank")).alias("at"))
    both = cut.withColumn("width", (F.octet_length("ids") / F.col("length")).cast("int")).drop("length").join(placed, "piece")
    own = F.substring(F.col("ids"), F.col("at.skip") * F.col("width") + 1, F.col("at.length") * F.col("width"))
    both = both.withColumn("ids", own).withColumn("start", F.col("start") + F.col("at.skip"))
    return both.select("doc_id", "doc_tokens", "start", "at.length", "ids", "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed pieces of all rows: (doc_id, doc_tokens, start, length, ids, sequence_id, offset).

    The rows of a sequence in order of ``offset`` are its tokens, gapless from 0.
    """
    return pack(pieces(docs, tokenizer_file, end_id, limit, id_col, text_col), limit)


def ids_crc32(ids: Column, tokenizer_file: str) -> Column:
    """Unsigned crc32 of id bytes, as unsigned little-endian 32-bit integers."""

    @F.pandas_udf("long")
    def crc(raw: pd.Series) -> pd.Series:
        dtype = memo(id_type, tokenizer_file)
        return pd.Series([zlib.crc32(np.frombuffer(r, dtype).astype("<u4")) for r in raw], dtype="int64")

    return crc(ids)
