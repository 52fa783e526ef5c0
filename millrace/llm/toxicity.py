"""Toxicity by a weighted pattern grammar over clauses.

A text is cut into clauses at sentence marks. Five transducers read the words of a clause, one after the other: insult
and threat words give weight, a word that points at a person (target) raises what comes with it, a negation before a
hit lowers it, and so does reported speech. Their composition is one automaton over word classes: a state is what the
clause has shown so far, an arc carries a factor or a weight. Only clauses with a hit score; a text's evidence is the
sum over its clauses, and a logistic curve turns it into a score.

The grammar is fixed; the weights and the insult words are learned from labelled rows. A pattern is a whole word or the
front of one. It is kept if the share of toxic rows among the training rows that hold it is higher than chance among
all patterns seen would explain. Near copies among the training rows are counted once, or else every word of a toxic
text with many copies would look like an insult. Training reads a sample of at most ``ROWS`` labelled rows of each
class, in the order of a hash of their id. Only the text is ever scored.

Null text counts as empty and has the score of a text without a hit. Labels that are null, of unknown ids, or double
(the largest counts) do no harm; without any labels the seed words alone are used.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import fresh, remainder, saved, with_small_batches

#: Labelled rows of each class that are learned from.
ROWS = 8000
#: Patterns that are kept at most, the best supported first.
PATTERNS = 4000
#: Characters of a word's front that may be a pattern.
FRONTS = range(4, 9)
WORDS = re.compile(r"[^\W\d_]+")
CLAUSES = re.compile(r"[.!?;:\n]+")

SEEDS = "idiot moron scum trash loser pathetic worthless disgusting stupid vermin bastard idiota imbécil basura escoria abschaum dummkopf trottel ordure crétin imbécile".split()
THREATS = "kill murder destroy strangle umbringen ermorden töten vernichten matar asesinar destruir tuer assassiner détruire".split()
TARGETS = "you your yourself he she they them him her people du dich dir ihr euch sie tu te toi vous ils elles tú ti usted ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor without nicht kein keine nie niemals ohne ne pas jamais sans nunca jamás sin ni".split()
REPORTS = "said says say wrote writes claimed reported quoted sagte sagt schrieb behauptete dit écrit déclaré dijo dice escribió afirmó".split()

#: Words after a negation that it still reaches.
REACH = 3
NEGATED, REPORTED, TARGETED = 0.6, 0.7, 1.25
#: Weight of a fixed threat word, alone and with a target.
THREAT, THREAT_AT = 0.5, 1.5


@dataclass
class Grammar:
    """Weights of whole words and of fronts of words, and the curve from evidence to score."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEEDS, 1.5))
    fronts: dict[str, float] = field(default_factory=dict)
    slope: float = 2.0
    shift: float = -3.0

    def __post_init__(self):
        self.seen: dict[str, tuple[str, float]] = {}
        self.fixed = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "report" for w in REPORTS} | {w: "threat" for w in THREATS}

    def read(self, word: str) -> tuple[str, float]:
        """Class of a lower-case word and its weight."""
        got = self.seen.get(word)
        if got is None:
            weight = max([self.words.get(word, 0.0)] + [self.fronts.get(word[:n], 0.0) for n in FRONTS if n <= len(word)])
            kind = "insult" if weight else self.fixed.get(word, "")
            got = (kind, weight)
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[word] = got
        return got

    def clause(self, words: list[str]) -> float:
        """Weight of a clause: the composed automaton, state (negation's reach, reported, target, open threats)."""
        reach, reported, target, total, threats = 0, 1.0, 1.0, 0.0, 0.0
        for word in words:
            kind, weight = self.read(word)
            if kind == "insult" or kind == "threat":
                factor = reported * (NEGATED if reach else 1.0)
                if kind == "insult":
                    total += weight * factor
                else:
                    threats += factor
            reach = max(0, reach - 1)
            if kind == "negation":
                reach = REACH
            elif kind == "report":
                reported = REPORTED
            elif kind == "target":
                target = TARGETED
        return total * target + threats * (THREAT_AT if target > 1 else THREAT)

    def evidence(self, text: str) -> float:
        text = text.lower()
        # A text none of whose words hits has no clause that scores.
        read = self.read
        if not any(read(w)[0] in ("insult", "threat") for w in set(WORDS.findall(text))):
            return 0.0
        return sum(self.clause(WORDS.findall(c)) for c in CLAUSES.split(text))

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * min(evidence, 20.0) + self.shift))))


def _patterns(text: str) -> set[str]:
    """Whole words, marked with a blank at the end, and fronts of words."""
    words = set(WORDS.findall(text.lower()))
    return {w + " " for w in words} | {w[:n] for w in words for n in FRONTS if n <= len(w)}


def _signature(text: str) -> list[int]:
    """Smallest hashes of the three-word shingles, two for each of four marks: near copies share a mark almost surely,
    texts that only share a passage rarely do."""
    words = WORDS.findall(text.lower())
    shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    hashes = np.array([zlib.crc32(s.encode()) for s in shingles], np.uint64)
    factors = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09], np.uint64)
    least = ((hashes[:, None] * factors >> np.uint64(7)) & np.uint64(0x7FFFFFFF)).min(axis=0)
    return (least[::2] << np.uint64(32) | least[1::2]).astype(np.int64).tolist()


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS) -> Grammar:
    """Grammar from the rows of ``labels`` (doc_id, toxic) for which ``usable``, an expression on doc_id, holds.

    The driver gets one short row per sampled document and the patterns that pass, both bounded.
    """
    with_small_batches(docs.sparkSession)
    marked = labels.filter(usable & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("id")
    sample = marked.filter("toxic = 1").orderBy(order, "id").limit(rows).union(marked.filter("toxic = 0").orderBy(order, "id").limit(rows))
    sample = saved(sample, "sample")
    share = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    texts = saved(texts, "labelled")

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "toxic": b["toxic"], "marks": [_signature(t) for t in b["text"]]})

    seen: list[set[int]] = [set(), set(), set(), set()]
    single = []
    for r in sorted(texts.mapInPandas(sign, "id long, toxic int, marks array<long>").collect(), key=lambda r: (-r["toxic"], r["id"])):
        if not any(m in s for m, s in zip(r["marks"], seen, strict=True)):
            single.append((r["id"], r["toxic"]))
        for m, s in zip(r["marks"], seen, strict=True):
            s.add(m)
    total = Counter(toxic for _, toxic in single)
    if not total[1] or not total[0]:
        return Grammar()
    chosen = saved(texts.join(F.broadcast(docs.sparkSession.createDataFrame(single, "id long, toxic int").select("id")), "id"), "single")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                got[int(toxic)].update(_patterns(text))
            names = list(got[0] | got[1])
            yield pd.DataFrame({"pattern": names, "clean": [got[0][p] for p in names], "toxic": [got[1][p] for p in names]})

    counts = chosen.mapInPandas(count, "pattern string, clean long, toxic long").groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = saved(counts, "patterns")
    base = total[1] / (total[1] + total[0])
    p, n = F.col("toxic") / (F.col("toxic") + F.col("clean")), F.col("toxic") + F.col("clean")
    gain = F.col("toxic") * F.log(p / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - p) / (1 - base))).otherwise(0.0)
    tried = max(2, counts.filter("toxic >= 3").count())
    passed = counts.filter((p > 2.5 * base / (1 + 1.5 * base)) & (gain > math.log(tried) + 2) & (n >= 3)).orderBy(F.desc("toxic"), "pattern").limit(PATTERNS)
    found = {r["pattern"]: (r["toxic"], r["clean"]) for r in passed.collect()}
    grammar = Grammar()
    for pattern, (toxic, clean) in found.items():
        longer = [q for q in found if len(q) == len(pattern) + 1 and q.startswith(pattern)] if not pattern.endswith(" ") else []
        if any(found[q][0] >= 0.95 * toxic for q in longer):
            continue  # the longer one says the same and touches fewer words
        weight = (math.log((toxic + 0.5) / (total[1] + 1)) - math.log((clean + 0.5) / (total[0] + 1))) / 4
        if pattern.endswith(" "):
            grammar.words[pattern[:-1]] = max(0.25, min(2.0, weight))
        else:
            grammar.fronts[pattern] = max(0.25, min(2.0, weight))
    _fit(grammar, chosen, share)
    return grammar


def _fit(grammar: Grammar, texts: DataFrame, share: dict[int, int]) -> None:
    """Curve from evidence to score on the training rows, which count by the true share of their class."""
    plain = (grammar.words, grammar.fronts)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Grammar(*plain)
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "evidence": [own.evidence(t) for t in b["text"]]})

    got = texts.mapInPandas(weigh, "toxic int, evidence double").collect()  # the sampled rows, two numbers each
    x = np.minimum(np.array([r["evidence"] for r in got]), 20.0)
    y = np.array([r["toxic"] for r in got], float)
    weight = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, (1 - y).sum()))
    weight /= weight.sum()
    a, b = 1.0, -2.0
    for _ in range(100):  # Newton steps with a small pull towards a flat curve, so that separable rows do no harm
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        q = weight * p * (1 - p)
        g = np.array([(weight * (p - y) * x).sum() + 1e-3 * a, (weight * (p - y)).sum() + 1e-4 * b])
        h = np.array([[(q * x * x).sum() + 1e-3, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-4]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        a, b = (np.array([a, b]) - step * min(1.0, 2.0 / max(size, 1e-9))).tolist()
        if size < 1e-8:
            break
    grammar.slope, grammar.shift = max(0.1, a), b


def score(text: Column, grammar: Grammar) -> Column:
    """Score of a text column, 0 to 1."""
    parts = (grammar.words, grammar.fronts, grammar.slope, grammar.shift)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Grammar(*parts)
        for texts in batches:
            yield pd.Series([own.score(own.evidence(t or "")) for t in texts], dtype="float64")

    return of(text)


def keep_clean(docs: DataFrame, grammar: Grammar, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``least``, with the columns of ``docs``."""
    with_small_batches(docs.sparkSession)
    parts, raw = (grammar.words, grammar.fronts, grammar.slope, grammar.shift), fresh(docs, "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(*parts)
        for batch in batches:
            at = batch.schema.get_field_index(raw)
            stay = pa.array([own.score(own.evidence(t or "")) < least for t in batch.column(at).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != at], [c for i, c in enumerate(batch.schema.names) if i != at]).filter(stay)

    return docs.withColumn(raw, F.col(text_col)).mapInArrow(run, StructType(docs.schema.fields))


def train_rows(id_col: str = "doc_id") -> Column:
    """Rows that labels may be learned from: three quarters, by the crc32 of the id."""
    return remainder(id_col, 4) != 2
