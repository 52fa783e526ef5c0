"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked where they differ in a few bits.

The comparison is exact. Distinct fingerprints are packed into tiles of equal population counts (one count per
16-bit word of the fingerprint). Two fingerprints whose counts differ by more than the radius, summed over the words,
differ in more bits than the radius, so such tile pairs are never built. The others are compared whole with numpy:
exclusive-or and bit counts. A tile pair gives a spanning forest of its links, not all of them, and the links of all
tile pairs are contracted to stars.

Null text counts as empty. A text without words has fingerprint 0, which is linked like any other. Rows with equal
fingerprints are one group before any comparison, so copies cost nothing. A null id never becomes a component id
unless the whole component has none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, saved, with_small_batches
from millrace.operators.skew import match_skewed

#: Fingerprints per tile: a pair of tiles takes at most 8 MB as a matrix.
TILE = 1024
#: Words of the fingerprint with a population count of their own.
BLOCKS = 4
WIDTH = 64 // BLOCKS
#: Seed of the shingle hash; Spark's xxhash64 uses the same.
SEED = 42


def fingerprint_bytes(text: bytes | None, words: int = 3) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    w = (text or b"").lower().split()  # on bytes, both touch ASCII only
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    hashed, total, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while chunk := [hashed(s, SEED) for s in itertools.islice(shingles if n else iter(shingles), 1 << 16)]:
        bits = np.unpackbits(np.array(chunk, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
        n += len(chunk)
        if len(w) < words or len(chunk) < 1 << 16:
            break
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """Fingerprint of a text column as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_bytes(t, words) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _tiles(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints as rows (key, first, fps): at most TILE fingerprints with equal population counts."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", WIDTH * k).bitwiseAND((1 << WIDTH) - 1)) for k in range(BLOCKS)]
    # Each count takes a byte of the key, moved up by 64 so that steps down do not borrow from the next byte.
    key = sum((F.shiftleft(c.cast("long") + 64, 8 * k) for k, c in enumerate(counts)), F.lit(0).cast("long"))
    keyed = fps.select("fp", key.alias("key"))
    spread = keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key: int, got: np.ndarray) -> Iterator[tuple]:
            for i in range(0, len(got), TILE):
                part = got[i : i + TILE]
                yield key, int(part[0]), part.tobytes()

        held_key, held = None, np.empty(0, np.int64)
        out: list[tuple] = []
        for batch in batches:
            keys = batch.column("key").to_numpy()
            values = batch.column("fp").to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if b == a:
                    continue
                if keys[a] == held_key:
                    held = np.concatenate([held, values[a:b]])
                else:
                    if held_key is not None:
                        out.extend(rows(held_key, held))
                    held_key, held = int(keys[a]), values[a:b].copy()
                if len(held) >= 2 * TILE:
                    full = len(held) // TILE * TILE
                    out.extend(rows(held_key, held[:full]))
                    held = held[full:]
            if out:
                yield _tile_batch(out)
                out = []
        if held_key is not None and len(held):
            out.extend(rows(held_key, held))
        if out:
            yield _tile_batch(out)

    return spread.mapInArrow(pack, "key long, first long, fps binary")


def _tile_batch(rows: list[tuple]) -> pa.RecordBatch:
    key, first, fps = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(first, pa.int64()), pa.array(fps, pa.binary())], ["key", "first", "fps"])


def _steps(radius: int) -> list[int]:
    """Key differences of tiles within the radius, one of each pair of opposite ones, and 0."""
    span = range(-radius, radius + 1)
    near = [d for d in itertools.product(span, repeat=BLOCKS) if sum(map(abs, d)) <= radius]
    return sorted(s for s in (sum(x << (8 * k) for k, x in enumerate(d)) for d in near) if s >= 0)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two arrays of unsigned fingerprints: (fingerprint, smaller one it joins)."""
    found = []
    step = max(1, (1 << 18) // max(1, len(b)))
    for i in range(0, len(a), step):
        x, y = np.nonzero(np.bitwise_count(a[i : i + step, None] ^ b[None, :]) <= radius)
        found.append((x + i, y))
    x, y = (np.concatenate(z) for z in zip(*found, strict=True))
    u, v = a[x].view(np.int64), b[y].view(np.int64)
    differ = u != v
    if not differ.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    nodes, ends = np.unique(np.concatenate([u[differ], v[differ]]), return_inverse=True)
    u, v = ends[: len(ends) // 2], ends[len(ends) // 2 :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (src, dst) that connect what is connected by links of at most ``radius`` bits. ``fps`` is distinct."""
    tiles = saved(_tiles(fps), "tiles")
    near = F.explode(F.array(*[F.lit(s).cast("long") for s in _steps(radius)]))
    visits = tiles.select(near.alias("step"), "key", F.col("first").alias("first2"), F.col("fps").alias("fps2"))
    visits = visits.select("step", (F.col("key") + F.col("step")).alias("key"), "first2", "fps2")
    # Counts near the middle have the most tiles, whose pairs grow with the square: such a key is cut into pieces.
    pairs = match_skewed(tiles, visits, ["key"], "inner").filter("step <> 0 or first <= first2").select("fps", "fps2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                tile_links(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), radius)
                for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            src, dst = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
            if len(src):
                src, dst = np.unique(np.stack([src, dst]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

    return pairs.mapInArrow(compare, "src long, dst long").distinct()


def roots(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """Connected components of links (src, dst): rows (node, root) for every node that is not its own root.

    Large-star and small-star contraction: each round joins every node with the smallest neighbour it knows. Rounds
    grow with the logarithm of the longest chain; each is written to the shared folder, no link reaches the driver.
    """
    edges = saved(edges.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")).filter("hi <> lo").distinct(), tag)
    mark = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.select("u", F.col("m").alias("v")))
        edges = saved(small.distinct().select(F.col("u").alias("hi"), F.col("v").alias("lo")), tag)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark = now


def _components(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of ``fps`` (id, fp): the smallest id that links reach."""
    distinct = saved(fps.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    star = roots(links(distinct.select("fp"), radius))
    member = star.select(F.col("node").alias("fp"), "root").union(star.select(F.col("root").alias("fp"), "root").distinct())
    member = member.join(distinct, "fp")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = member.select("fp", "root").join(least, "root").select("fp", "component_id")
    return distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(id, fingerprint long, component_id) of every row; ``component_id`` is the smallest id of its component."""
    with_small_batches(docs.sparkSession)
    fps = saved(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    out = match_skewed(fps, _components(fps, radius), ["fp"], "inner")  # copies may hold any share of the rows
    return out.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component of near-duplicates, the one with the smallest id, with the columns of ``docs``.

    Repeated rows are told apart by their place in the written table, so exactly one stays. Rows without an id stay
    only where their component has no other.
    """
    with_small_batches(docs.sparkSession)
    fp, place = fresh(docs, "fp"), fresh(docs, "place")
    rows = saved(docs.withColumn(fp, fingerprint(F.col(text_col), words)).withColumn(place, F.monotonically_increasing_id()), "documents")
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(place).alias("place"))
    best = _components(rows.select(rank.alias("id"), F.col(fp).alias("fp")), radius)
    stay = best.select(F.col("component_id.place").alias(place)).distinct()
    return rows.join(stay, place, "left_semi").drop(fp, place)
