"""Join of documents whose sets of word n-grams are alike: exact Jaccard similarity by universe partition.

A token is the 64-bit hash of an n-gram; a document's set holds its distinct tokens, in order. Documents with equal
sets are one record. Records are dealt to bands of set sizes; a record meets those of its own band and, if small
enough, of the band below. Within a band, alike sets differ in ``reach`` tokens at most. The universe of tokens is cut
into segments, and pigeonhole says: if segment ``i`` may differ in ``e_i`` tokens and the ``e_i + 1`` add up to more than
``reach``, then two alike sets keep within ``e_i`` in some segment. A record is indexed by the subset of its tokens in
each segment (``e_i = 0``) and, for segments with ``e_i = 1``, also by that subset less each one of its tokens. Fewer and
larger segments with deletions give more entries and fewer chance meetings (two empty segments agree): the number of
segments is chosen for each band by the cost of both, from the counts of all documents.

Records that share an entry are candidates, and candidates are verified on the whole sets. A group of records with one
entry is never expanded into all pairs: first each is held against the group's pivots, links are contracted to
components, and groups whose records are all in one component are done. What is left is compared tile by tile inside
the tasks, passing over pairs in one component and pairs whose parity sketches differ in more bits than alike sets can:
first on the whole sets, in the largest groups of every record, which gives a spanning forest of links there; then, with
the components known by then, in all groups that are still open, where the few pairs that may be alike become rows and
are verified. So a large group of near copies costs few rows, and no link between components is lost.

Null text counts as empty; a text without words has an empty set and is linked with nothing. Repeated rows and equal ids
are treated like any other rows; a null id never becomes a component id unless the whole component has none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import saved, with_small_batches
from millrace.llm.simhash import roots
from millrace.operators.skew import heavy_keys, key_hash, match_skewed

SEED = 42
#: A band reaches from its smallest size to that size divided by the similarity, so many times.
SPAN = 2
#: Cost of a candidate pair, in index entries.
PAIR_COST = 50.0
#: Records and tokens that a tile of one group holds about.
TILE, TILE_TOKENS = 256, 1 << 17
#: Groups of a record that are compared on whole sets.
LARGEST = 4
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values of 64-bit values, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def token_set(text: bytes | None, words: int) -> np.ndarray:
    """Distinct n-gram hashes of a UTF-8 text in ascending order."""
    w = (text or b"").lower().split()  # on bytes, both touch ASCII only
    if not w:
        return np.empty(0, np.uint64)
    grams = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*(itertools.islice(w, i, None) for i in range(words)), strict=False))
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(g, SEED) for g in grams], np.uint64))


def set_key(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh128_digest(tokens.tobytes()) if len(tokens) else None


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high`` tokens, and those of up to ``top`` that they may be alike."""

    low: int
    high: int
    top: int
    reach: int  # tokens in which alike sets may differ
    segments: int
    deletions: int  # the first segments, with one-deletion neighbourhoods


class Bands:
    """Bands and their segments for a similarity of ``least`` per cent."""

    def __init__(self, least: int, sizes: list[tuple[float, int]], pair_cost: float = PAIR_COST):
        """``sizes``: (mean set size, documents) of groups of documents, which only steer costs."""
        if not 0 < least <= 100:
            raise ValueError("least is a per cent above 0")
        self.least, self.sizes, self.pair_cost, self.bands = least, sizes, pair_cost, []

    def _most(self, size: int) -> int:
        return size * 100 // self.least

    def distance(self, a, b):
        """Tokens in which alike sets of these sizes may differ at most."""
        return (a + b) - 2 * (-(-self.least * (a + b) // (100 + self.least)))

    def _add(self) -> None:
        low = self.bands[-1].high + 1 if self.bands else 1
        high = low
        for _ in range(SPAN):
            high = max(high, self._most(high))
        top = self._most(high)
        reach = (high + top) * (100 - self.least) // (100 + self.least)
        self.bands.append(Band(low, high, top, reach, *self._allocate(low, top, reach)))

    def _allocate(self, low: int, top: int, reach: int) -> tuple[int, int]:
        """(segments, segments with deletions) of least cost, over all ways to allow ``reach`` differences."""
        met = [(size, n) for size, n in self.sizes if low <= size <= top]
        count = max(1, sum(n for _, n in met))
        size = sum(size * n for size, n in met) / count if met else (low + top) / 2
        m = np.arange((reach + 2) // 2, reach + 2, dtype=np.float64)  # m + deletions = reach + 1
        deletions = reach + 1 - m
        entries = m + deletions * size / m
        none = (1 - 1 / m) ** size  # chance of an empty segment
        one = np.where(m > 1, none * size / np.maximum(m - 1, 1), size <= 1)  # of a segment with one token
        meetings = (m - deletions) * none**2 + deletions * (none + one) ** 2
        best = int(np.argmin(count * entries + self.pair_cost * count * count / 2 * meetings))
        return int(m[best]), int(deletions[best])

    def of(self, size: int) -> list[tuple[int, Band]]:
        """Number and band of every group that a set of this size is in."""
        while not self.bands or self.bands[-1].high < size:
            self._add()
        at = next(i for i, b in enumerate(self.bands) if size <= b.high)
        below = [(at - 1, self.bands[at - 1])] if at and size <= self.bands[at - 1].top else []
        return [(at, self.bands[at]), *below]

    def entries(self, tokens: np.ndarray) -> np.ndarray:
        """Index entries of a set; none where only equal sets are alike."""
        out = [self._band_entries(tokens, g, b) for g, b in self.of(len(tokens)) if b.reach] if len(tokens) else []
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)

    def _band_entries(self, tokens: np.ndarray, group: int, band: Band) -> np.ndarray:
        m = np.uint64(band.segments)
        # Tokens ascend and segments follow their high bits, so that a segment is a slice.
        segment = ((tokens >> np.uint64(32)) * m >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(segment, np.arange(band.segments + 1))
        with np.errstate(over="ignore"):
            mixed = mix(tokens)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
            base = np.arange(1, band.segments + 1, dtype=np.uint64) * _A + np.uint64(group + 1) * _B
            whole = sums[cut[1:]] - sums[cut[:-1]] + base
            less = whole[segment[: cut[band.deletions]]] - mixed[: cut[band.deletions]]
        return mix(np.concatenate([whole, less]))

    def sketch_bits(self, size: int) -> int:
        """Bits of the parity sketch: a power of two, several times the differences allowed."""
        return 1 << max(6, (16 * self.of(size)[0][1].reach).bit_length())

    def sketch(self, tokens: np.ndarray) -> np.ndarray:
        """Parity of the tokens that fall on each bit. Sets that differ in d tokens differ in d bits at most."""
        bits = self.sketch_bits(len(tokens))
        odd = np.bincount((mix(tokens ^ _B) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketch of fewer words from one of more: halves are added, parities being additive."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def alike(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether 100 x common tokens reach ``least`` x all tokens of both."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= least * (len(a) + len(b) - both)


def _sizes(docs: DataFrame, text_col: str, words: int) -> list[tuple[float, int]]:
    """(mean, rows) of words less ``words - 1``, by ranges of a quarter octave: a few hundred rows at most."""
    n = F.greatest(F.size(F.split(F.col(text_col), r"[\x20\x09-\x0D]+")) - (words - 1), F.lit(1)).alias("n")
    rows = docs.select(n).filter("n is not null").groupBy(F.floor(F.log2("n") * 4)).agg(F.avg("n").alias("mean"), F.count(F.lit(1)).alias("rows"))
    return [(r["mean"], r["rows"]) for r in rows.collect()]


def _keyed(docs: DataFrame, words: int, bands: Bands | None) -> DataFrame:
    """(id, n, key) of rows (id, text), with the index entries where ``bands`` are given."""
    kind = docs.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n long, key binary" + (", entries array<long>" if bands else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [token_set(t, words) for t in batch.column("text").to_pylist()]
            columns = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(set_key, sets), pa.binary())]
            if bands:
                found = [bands.entries(s) for s in sets]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "key", "entries"][: len(columns)])

    return docs.mapInArrow(work, shape)


def _records(docs: DataFrame, words: int, bands: Bands) -> DataFrame:
    """(rec, key, least, n, entries): one record for each distinct set that is not empty, ``least`` its smallest id."""
    keyed = _keyed(docs, words, bands).filter("n > 0")
    once = keyed.groupBy("key").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("entries").alias("entries"))
    return saved(once.withColumn("rec", F.monotonically_increasing_id()), "records")


def _shared(records: DataFrame) -> DataFrame:
    """(entry, rec, n, pivot) of the entries that several records have; a frequent entry has a pivot for each of its pieces."""
    entries = records.select("rec", "n", F.explode("entries").alias("entry"))
    heavy = F.broadcast(heavy_keys(entries, ["entry"]).withColumnRenamed("hash", "h"))  # 8 x partitions rows at most
    cut = entries.withColumn("h", key_hash(["entry"])).join(heavy, "h", "left").drop("h")
    cut = cut.withColumn("piece", F.pmod(F.xxhash64("rec"), F.coalesce("pieces", F.lit(1))))
    piece = Window.partitionBy("entry", "piece")
    first = F.min(F.struct("rec", "n", F.col("rec").alias("label"))).over(piece)
    cut = cut.withColumn("c", F.count(F.lit(1)).over(piece)).withColumn("pivot", first)
    return saved(cut.filter("c > 1 or pieces > 1").select("entry", "rec", "n", "pivot"), "shared")


def _sets(docs: DataFrame, records: DataFrame, shared: DataFrame, words: int, bands: Bands) -> DataFrame:
    """(rec, tokens, sketch) of the records that share entries, from one text each."""
    wanted = records.join(shared.select("rec").distinct(), "rec").select("rec", F.col("key").alias("want"), "least")
    rows = docs.join(wanted, F.col("id").eqNullSafe(F.col("least"))).select("rec", "want", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("rec", "want", "text")), strict=True)
            found = [(rec, s) for rec, want, text in rows if set_key(s := token_set(text, words)) == want]
            blobs = [pa.array([f(s) for _, s in found], pa.binary()) for f in (bytes, lambda s: bytes(bands.sketch(s)))]
            yield pa.RecordBatch.from_arrays([pa.array([rec for rec, _ in found], pa.int64()), *blobs], ["rec", "tokens", "sketch"])

    return saved(rows.mapInArrow(work, "rec long, tokens binary, sketch binary").dropDuplicates(["rec"]), "sets")


def _labelled(shared: DataFrame, links: DataFrame) -> DataFrame:
    """(entry, rec, n, label): ``shared`` with the component of every record as far as it is known."""
    known = roots(links).select(F.col("node").alias("rec"), "root")
    # A record has no more entries than its own set asks for, so no record is a hot key.
    return saved(shared.join(known, "rec", "left").select("entry", "rec", "n", F.coalesce("root", "rec").alias("label")), "labelled")


def _open(labelled: DataFrame) -> DataFrame:
    """Rows of the groups whose records are in several components, with the ``pivot``, records and tokens of the group.

    Components only grow, so other groups stay done.
    """
    ends = labelled.groupBy("entry").agg(
        F.max(F.struct("rec", "n", "label")).alias("pivot"),
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("t"),
        F.min("label").alias("lo"),
        F.max("label").alias("hi"),
    )
    return saved(labelled.join(ends.filter("lo <> hi").drop("lo", "hi"), "entry"), "undone")


def _against_pivots(rows: DataFrame, least: int) -> DataFrame:
    """(a, b) of every record a and the pivot b of each of its groups, where they are not yet in one component."""
    m = F.col("pivot.n")
    near = F.least("n", m) * 100 >= F.greatest("n", m) * least
    pairs = rows.filter((F.col("label") != F.col("pivot.label")) & near)
    return saved(pairs.select(F.col("rec").alias("a"), F.col("pivot.rec").alias("b")).distinct(), "pairs")


def _against_all(undone: DataFrame, sets: DataFrame, bands: Bands, complete: int, exact: bool) -> DataFrame:
    """(a, b) of what is open in groups of more than ``complete`` records: all pairs that size and sketch allow.

    With ``exact`` links only, a spanning forest of those in the ``LARGEST`` groups of every record. Records are dealt to
    tiles by a hash, and every pair of tiles of a group is a row that one task compares.
    """
    tiles = F.ceil(F.greatest(F.col("k") / TILE, F.col("t") / TILE_TOKENS)).cast("int")
    rows = undone.filter(F.col("k") > complete).select("entry", "rec", "n", "label", "k", tiles.alias("tiles"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("rec"), F.col("tiles")).cast("int"))
    if exact:
        place = F.row_number().over(Window.partitionBy("rec").orderBy(F.desc("k"), "entry"))
        rows = rows.withColumn("place", place).filter(F.col("place") <= LARGEST).drop("place")
    shown = ["sketch", "tokens"] if exact else ["sketch"]
    rows = saved(rows.drop("k"), "open").join(sets.select("rec", *shown), "rec")
    tiles = saved(rows.groupBy("entry", "tiles", "tile").agg(F.collect_list(F.struct("rec", "n", "label", *shown)).alias("t")), "tiles")
    upper = F.explode(F.sequence(F.col("tile"), F.col("tiles") - 1))
    left = tiles.select("entry", F.col("tile").alias("x"), upper.alias("y"), "t")
    right = tiles.select("entry", F.explode(F.sequence(F.lit(0), "tile")).alias("x"), F.col("tile").alias("y"), F.col("t").alias("u"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [pair for t, u in zip(frame["t"], frame["u"], strict=True) for pair in compare_tiles(t, u, bands, exact)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return saved(left.join(right, ["entry", "x", "y"]).select("t", "u").mapInPandas(compare, "a long, b long").distinct(), "pairs")


def compare_tiles(t, u, bands: Bands, exact: bool) -> list[tuple[int, int]]:
    """Pairs of records (rec, n, label, sketch) of two tiles, or of one if both are the same, that may be alike.

    With ``exact`` the records have their tokens, and what comes back are links that join what closer ones did not.
    """
    rows = [*t, *u]
    rec, n, label = (np.array([r[c] for r in rows], np.int64) for c in ("rec", "n", "label"))
    sketches = [np.frombuffer(r["sketch"], np.uint64) for r in rows]
    tokens = [np.frombuffer(r["tokens"], np.uint64) for r in rows] if exact else []
    words = min(map(len, sketches))
    sketch = np.stack([folded(s, words) for s in sketches])
    same = rec[0] == rec[len(t)]
    found = []
    for i in range(len(t)):
        at = np.arange(i + 1 if same else len(t), len(t) if same else len(rows))
        at = at[(label[i] != label[at]) & (100 * np.minimum(n[i], n[at]) >= bands.least * np.maximum(n[i], n[at]))]
        apart = np.bitwise_count(sketch[i] ^ sketch[at]).sum(axis=1, dtype=np.int64)
        near = apart <= bands.distance(n[i], n[at])
        found.append(np.stack([apart[near], np.full(near.sum(), i), at[near]]))
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[1:, np.lexsort((rec[pairs[2]], rec[pairs[1]], pairs[0]))].T.tolist()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for i, j in pairs:
        if exact:
            a, b = root(int(label[i])), root(int(label[j]))
            if a == b or not alike(tokens[i], tokens[j], bands.least):
                continue
            parent[a] = b
        out.append((max(int(rec[i]), int(rec[j])), min(int(rec[i]), int(rec[j]))))
    return out


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(src, dst) of the pairs (a, b) whose whole sets are alike; b may be in very many pairs, a in few."""
    own = lambda side: sets.select(F.col("rec").alias(side), F.col("tokens").alias(f"{side}_tokens"))
    rows = match_skewed(pairs, own("b"), ["b"], "inner").join(own("a"), "a")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("a_tokens", "b_tokens")]
            good = pa.array([alike(x, y, least) for x, y in zip(*tokens, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good).rename_columns(["src", "dst"])

    return saved(rows.select("a", "b", "a_tokens", "b_tokens").mapInArrow(work, "src long, dst long"), "links")


def alike_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    least: int = 90,
    pair_cost: float = PAIR_COST,
) -> DataFrame:
    """(id, n, component_id) of every row: set size and smallest id that links reach.

    Two sets link when their Jaccard similarity is ``least`` per cent or more.
    """
    spark = docs.sparkSession
    with_small_batches(spark)
    bands = Bands(least, _sizes(docs, text_col, words), pair_cost)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    records = _records(docs, words, bands)
    shared = _shared(records)
    sets = _sets(docs, records, shared, words, bands)
    links = _verified(_against_pivots(shared.withColumn("label", F.col("rec")), least), sets, least)
    # After two pivots, groups of three are complete. Each step reads only what the one before has left open.
    undone = _open(_labelled(shared, links))
    links = links.union(_verified(_against_pivots(undone, least), sets, least))
    undone = _open(_labelled(undone.drop("label"), links))
    links = links.union(_against_all(undone, sets, bands, 3, exact=True).toDF("src", "dst"))
    undone = _open(_labelled(undone.drop("label"), links))
    links = links.union(_verified(_against_all(undone, sets, bands, 3, exact=False), sets, least))
    star = roots(links).select(F.col("node").alias("rec"), "root")
    member = star.union(star.select(F.col("root").alias("rec"), "root").distinct()).join(records.select("rec", "least"), "rec")
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = match_skewed(member.select("rec", "root"), smallest, ["root"]).select("rec", "component_id")
    classes = records.join(linked, "rec", "left").select("key", F.coalesce("component_id", "least").alias("component_id"))
    keyed = saved(_keyed(docs, words, None), "keyed")
    out = match_skewed(keyed, saved(classes, "classes"), ["key"])
    return out.select(F.col("id").alias(id_col), "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def duckdb_sql(words: int = 3, least: int = 90, table: str = "documents") -> str:
    """The query's rows as DuckDB SQL over a table with doc_id and text: all links by shingle, then what they reach."""
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM {table}),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s FROM split),
sized AS (SELECT doc_id, s, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id AND {least} * a.n <= 100 * b.n AND {least} * b.n <= 100 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {least} * (a.n + b.n - count(*))),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT sized.doc_id, n AS n_shingles, least(sized.doc_id, coalesce(m, sized.doc_id)) AS component_id
FROM sized LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) USING (doc_id)"""
