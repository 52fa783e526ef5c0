"""Importance resampling towards a target: documents whose hashed n-grams look like the target texts' are drawn.

Words are runs of letters a-z, digits and characters outside ASCII, after lower-casing A-Z; everything else delimits.
A feature is a run of 1 to ``n_max`` words joined by one blank, its bucket the crc32 of its UTF-8 bytes modulo
``buckets``.

An Aho-Corasick automaton holds distinct words, each between two delimiters, with the word's crc32 and length as its
payload. A scan of a text emits one payload for each word that the automaton knows. Words it does not know show as gaps
between the matches; they are hashed by themselves and learned, and the automaton is built anew when it has grown by a
half, up to ``WORDS`` words a Python worker. What it holds changes only how soon a payload is found, never the payload.
Longer features never touch the text again: the crc32 of a run is composed from its words' payloads, because crc32 is
linear: moving a checksum past ``k`` bytes is a 32 x 32 bit matrix, applied by tables to all runs at once.

Both corpora are counted by bucket inside the tasks, at most ``buckets`` rows a task, and the driver gets one number per
bucket. Null text counts as empty, null ids as empty text in the noise. Rows with equal ids and scores may share ranks
in any order among themselves. An empty target or corpus gives gains from the added ones alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import memo, quantiles, saved, with_small_batches

#: Words that one worker's automaton holds at most, and bytes of words; others are hashed each time they occur.
WORDS = 200_000
WORD_BYTES = 64
#: Bytes that a scan takes at once; a longer text is cut at delimiters.
BLOCK = 4 << 20
#: Every byte as the scan sees it: lower case, and one blank for whatever delimits.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_CRC_BITS = 32


def _apply(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Bit matrix (column k: image of bit k) times many checksums, by four tables of 256."""
    out = np.zeros_like(crc)
    for byte in range(4):
        images = np.zeros(256, np.uint32)
        for k in range(8):
            images[1 << k : 2 << k] = images[: 1 << k] ^ matrix[8 * byte + k]
        out ^= images[(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _powers(n: int) -> list[np.ndarray]:
    """Matrices that move a crc32 past 1, 2, 4, ... bytes."""
    one = np.array([1 << k for k in range(_CRC_BITS)], np.uint32)
    bit = np.where(one & 1, np.uint32(0xEDB88320), one >> np.uint32(1)).astype(np.uint32)
    for _ in range(3):  # 1, 2, 4, 8 bits
        bit = _apply(bit, bit)
    out = [bit]
    while len(out) < n:
        out.append(_apply(out[-1], out[-1]))
    return out


POWERS = _powers(40)


def compose(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of left + right from both checksums and the right parts' lengths in bytes."""
    out = left.copy()
    for k, matrix in enumerate(POWERS):
        if not (lengths >> k).any():
            break
        move = np.flatnonzero(lengths >> k & 1)
        out[move] = _apply(matrix, out[move])
    return out ^ right


class Dictionary:
    """Payloads of words by automaton: crc32 in the low 32 bits, length in the others."""

    def __init__(self, limit: int = WORDS):
        self.limit, self.payload, self.built, self.automaton, self.table = limit, {}, 0, None, None

    def _learn(self, word: bytes) -> int:
        payload = self.payload.get(word)
        if payload is None:
            payload = zlib.crc32(word) | len(word) << 32
            if len(self.payload) < self.limit and len(word) <= WORD_BYTES:
                self.payload[word] = payload
        return payload

    def _build(self) -> None:
        if 2 * len(self.payload) < 3 * self.built or len(self.payload) == self.built:
            return
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, word in enumerate(self.payload):
            self.automaton.add_word(f" {word.decode('latin-1')} ", k)  # latin-1: one character a byte
        self.automaton.make_automaton()
        self.table = np.fromiter(self.payload.values(), np.int64, len(self.payload))  # it stores 32 bits a word itself
        self.built = len(self.payload)

    def scan(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(starts, payloads) of the words of a folded text that begins and ends with a delimiter."""
        raw = np.frombuffer(folded, np.uint8)
        edge = np.diff((raw != 32).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        found = np.zeros(len(starts), np.int64)
        if self.automaton is not None:
            pairs = np.array(list(self.automaton.iter(folded.decode("latin-1"))), np.int64).reshape(-1, 2)
            found[np.searchsorted(ends, pairs[:, 0])] = self.table[pairs[:, 1]]  # a match ends at the delimiter behind its word
        for i in np.flatnonzero(found == 0):
            found[i] = self._learn(folded[starts[i] : ends[i]])
        self._build()
        return starts, found

    def payloads(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, word counts of the texts from there on, payloads in order) of blocks of whole texts."""
        first = 0
        while first < len(texts):
            size, last = 0, first
            while last < len(texts) and (last == first or size + len(texts[last]) <= BLOCK):
                size += len(texts[last])
                last += 1
            joined = b"".join([b" ", *(t.translate(FOLD) + b" " for t in texts[first:last])])
            cuts = np.cumsum([0, *(len(t) + 1 for t in texts[first:last])])
            parts = [self.scan(piece) for piece in pieces(joined)]
            offsets = np.cumsum([0, *(len(piece) - 1 for piece in pieces(joined))])
            starts = np.concatenate([p[0] + o for p, o in zip(parts, offsets, strict=False)])
            yield first, np.diff(np.searchsorted(starts, cuts, "right")), np.concatenate([p[1] for p in parts])
            first = last


def pieces(folded: bytes) -> list[bytes]:
    """Cut at delimiters into pieces of about ``BLOCK`` bytes; neighbours share the delimiter between them."""
    out, at = [], 0
    while len(folded) - at > 2 * BLOCK:
        cut = folded.find(b" ", at + BLOCK)
        if cut < 0 or cut == len(folded) - 1:
            break
        out.append(folded[at : cut + 1])
        at = cut
    return [*out, folded[at:]]


def features(counts: np.ndarray, payloads: np.ndarray, n_max: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text of each feature as its place among ``counts``, bucket of each feature)."""
    text = np.repeat(np.arange(len(counts)), counts)
    word, length = (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32
    blank = np.uint32(zlib.crc32(b" "))
    texts, found, run = [text], [word], word
    for k in range(1, n_max):
        whole = text[k:] == text[: len(text) - k] if len(text) > k else np.zeros(0, bool)
        run = run[: len(whole)]
        gap = compose(run, np.full(len(run), blank), np.ones(len(run), np.int64))
        run = compose(gap, word[k : k + len(run)], length[k : k + len(run)])
        texts.append(text[: len(whole)][whole])
        found.append(run[whole])
    return np.concatenate(texts), (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").to_pylist()]


def bucket_counts(texts: DataFrame, n_max: int, buckets: int, text_col: str = "text") -> DataFrame:
    """(bucket, n) of all features of a table; buckets without features have no row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = np.zeros(buckets, np.int64), memo(Dictionary)
        for batch in batches:
            for _, counts, payloads in words.payloads(_texts(batch)):
                total += np.bincount(features(counts, payloads, n_max, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: DataFrame, corpus: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket from (bucket, n) of both sides; the driver gets one number per bucket."""
    t = target.withColumnRenamed("n", "t").join(corpus.withColumnRenamed("n", "s"), "bucket", "full")
    t = saved(t.select("bucket", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("s", F.lit(0)).alias("s")), "buckets")
    sums = t.agg(F.sum("t").alias("t"), F.sum("s").alias("s")).first()
    num = lambda c, k: c.cast("double") + F.lit(float(k))
    gain = F.floor(F.log(num(F.col("t"), 1) * float((sums["s"] or 0) + buckets) / (num(F.col("s"), 1) * float((sums["t"] or 0) + buckets))) * 1000.0)
    none = F.floor(F.log(F.lit(float((sums["s"] or 0) + buckets)) / F.lit(float((sums["t"] or 0) + buckets))) * 1000.0)
    out = np.full(buckets, t.sparkSession.range(1).select(none.alias("g")).first()["g"], np.int64)
    for row in t.select("bucket", gain.alias("g")).collect():
        out[row["bucket"]] = row["g"]
    return out


def weights(docs: DataFrame, gain: np.ndarray, n_max: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    buckets = len(gain)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = memo(Dictionary)
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for first, counts, payloads in words.payloads(_texts(batch)):
                text, bucket = features(counts, payloads, n_max, buckets)
                at = slice(first, first + len(counts))
                out[0, at] = counts
                out[1, at] = np.bincount(text, minlength=len(counts))
                np.add.at(out[2], text + first, gain[bucket])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, out)], ["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def noise(doc_id, seed: str):
    """floor(-1000 ln(-ln u)) of a number u between 0 and 1 that a hash of seed and id fixes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def ranked(scored: DataFrame, eligible, percent: int, id_col: str) -> DataFrame:
    """``scored`` with the column ``rank`` of the drawn rows: highest scores first, then smaller ids; null for others.

    Boundaries cut the scores into even ranges, the driver gets the row count of each range, and rows are numbered
    inside their range only. Ranges below the last one needed are never sorted.
    """
    spark = scored.sparkSession
    rows = scored.withColumn("eligible", eligible)
    able = rows.filter("eligible")
    bounds = quantiles(able, "score", int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < F.col("score"))) if bounds else F.lit(0)
    rows = rows.withColumn("range", at)
    sizes = {r["range"]: r["n"] for r in rows.filter("eligible").groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota = sum(sizes.values()) * percent // 100
    before, total = {}, 0
    for part in sorted(sizes, reverse=True):
        if total < quota:
            before[part] = total
        total += sizes[part]
    none = F.lit(None).cast("long")
    if not before:
        return rows.drop("eligible", "range").withColumn("rank", none)
    near = F.col("eligible") & (F.col("range") >= min(before))
    offset = F.element_at(F.create_map(*[F.lit(x).cast(k) for p, n in before.items() for x, k in ((p, "int"), (n, "long"))]), F.col("range"))
    order = Window.partitionBy("range").orderBy(F.desc("score"), F.asc(id_col), "n_features")
    place = (F.row_number().over(order) + offset).cast("long")
    drawn = rows.filter(near).withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return rows.filter(~near).withColumn("rank", none).union(drawn).drop("eligible", "range")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    n_max: int = 2,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``docs``.

    Of the rows with at least ``least_words`` words the ``percent`` per cent with the highest scores are drawn; the
    others' rank is null.
    """
    with_small_batches(docs.sparkSession)
    gain = gains(bucket_counts(target, n_max, buckets, target_col), bucket_counts(docs, n_max, buckets, text_col), buckets)
    scored = weights(docs, gain, n_max, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    out = ranked(saved(scored, "scores"), F.col("n_words") >= least_words, percent, "id")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def duckdb_sql(buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024", docs: str = "documents", target: str = "benchmark") -> str:
    """Rows for single words as DuckDB SQL: crc32 byte by byte, over the distinct words of both tables."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS step FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT i, c FROM bits WHERE step = 8),
split AS (SELECT doc_id, {words} AS words FROM {docs}),
wanted AS (SELECT {words} AS words FROM {target}),
doc_words AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM split) GROUP BY ALL),
target_words AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM wanted) GROUP BY ALL),
vocabulary AS (SELECT word, hex(encode(word)) AS bytes FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words)),
walk AS (
  SELECT word, bytes, 0 AS pos, 4294967295::BIGINT AS c FROM vocabulary
  UNION ALL
  SELECT word, bytes, pos + 1, xor(walk.c >> 8, t.c)
  FROM walk JOIN crc_table t ON t.i = xor(walk.c & 255, ('0x' || substr(bytes, 2 * pos + 1, 2))::BIGINT) WHERE 2 * pos < length(bytes)),
hashed AS (SELECT word, xor(c, 4294967295) % {buckets} AS bucket FROM walk WHERE 2 * pos = length(bytes)),
corpus AS (SELECT bucket, sum(n)::DOUBLE AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
goal AS (SELECT bucket, sum(n)::DOUBLE AS t FROM target_words JOIN hashed USING (word) GROUP BY bucket),
whole AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS s, (SELECT coalesce(sum(t), 0) FROM goal) AS t),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(goal.t, 0) + 1) * (whole.s + {buckets}) / ((corpus.s + 1) * (whole.t + {buckets}))))::BIGINT AS g
  FROM corpus LEFT JOIN goal USING (bucket) CROSS JOIN whole),
weighed AS (SELECT doc_id, sum(n * g)::BIGINT AS weight FROM doc_words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE)
         / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weighed USING (doc_id)),
able AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= {least_words}),
quota AS (SELECT count(*) * {percent} // 100 AS n FROM able)
SELECT doc_id, n_features, weight, score, CASE WHEN able.rank <= quota.n THEN able.rank END AS rank
FROM scored LEFT JOIN able USING (doc_id) CROSS JOIN quota"""
