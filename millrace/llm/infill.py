"""Fill-in-the-middle examples: a text is cut at two unit ranks and its parts are put in another order.

Units are the matches of a pattern, lines by default. The units of a text lie in an indexable skip list: the lowest
lane links every unit, each express lane about one in ``FAN`` of the lane below, and every link carries two widths, how
many units and how many code points it spans. A rank is reached from the top lane downwards by adding up the unit
widths of the links taken; the code-point widths added up on the same way are the place of the cut. Express lanes are
chosen by a hash of the unit's rank, so a repeated task builds the same list.

Null text counts as empty. A text that is empty or holds a sentinel stays as it is, form ``plain``. Rows are treated
one by one: repeated rows and equal ids give equal results, a null id counts as empty text in the hash, and no column
but the id and the text is read or returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import with_small_batches

LINES = r"[^\n]*\n|[^\n]+"
#: Links of a lane that one link of the lane above spans on average.
FAN = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)  # golden ratio in 64 bits, the usual multiplier for whole numbers


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len({*marks}) < 3 or not all(marks) or any(a in b for a in marks for b in marks if a != b):
            raise ValueError("sentinels must be different and none may hold another")
        if any(a.startswith(b[-k:]) for a in marks for b in marks for k in range(1, min(len(a), len(b)))):
            raise ValueError("sentinels must not overlap")


class SkipList:
    """Units in order, by their lengths in code points; ``reach`` finds the place of a unit rank."""

    def __init__(self, lengths: np.ndarray):
        n = len(lengths)
        self.n = n
        # One lane: unit widths, code-point widths, and for each link the first link below that it spans.
        self.lanes = [(np.ones(n, np.int64), np.asarray(lengths, np.int64), None)]
        ends = np.arange(1, n + 1, dtype=np.int64)  # rank at which each link of the lane ends
        while len(ends) > FAN:
            units, chars, _ = self.lanes[-1]
            mixed = (ends.astype(np.uint64) * _ODD) >> np.uint64(64 - 2 * len(self.lanes))
            stops = np.flatnonzero(mixed == 0)  # FAN is 4: two more zero bits on every lane
            first = np.concatenate([[0], stops + 1])
            first = first[first < len(ends)]
            if len(first) == len(ends):
                break
            self.lanes.append((np.add.reduceat(units, first), np.add.reduceat(chars, first), first))
            ends = np.concatenate([ends[first[1:] - 1], ends[-1:]])

    def reach(self, rank: int) -> int:
        """Code points before the unit of that rank (0 to n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        link, done, place = 0, 0, 0
        for units, chars, below in reversed(self.lanes):
            while link < len(units) and done + units[link] <= rank:
                done += int(units[link])
                place += int(chars[link])
                link += 1
            if done == rank:
                break
            if below is not None:
                link = int(below[link])
        return place


def unit_lengths(text: str, pattern: re.Pattern) -> np.ndarray:
    """Code points of every unit. Units must follow one another without a gap."""
    spans = [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
    got = np.diff(np.array([0, *spans], np.int64))
    if text and (not spans or spans[-1] != len(text) or sum(map(len, pattern.findall(text))) != len(text)):
        raise ValueError("the pattern leaves parts of the text out")
    return got


def line_lengths(text: str) -> np.ndarray:
    """Code points of every line with its line end, as ``LINES`` matches them."""
    parts = text.split("\n")
    got = np.fromiter(map(len, parts), np.int64, len(parts))
    got[:-1] += 1
    return got if parts[-1] else got[:-1]


@dataclass(frozen=True)
class Plan:
    """How cuts and forms are drawn: ``rate`` of 100 texts are transformed, ``spm`` of 100 of these suffix first."""

    seed: str = "7"
    rate: int = 100
    spm: int = 50
    pattern: str = LINES
    sentinels: Sentinels = Sentinels()

    def draws(self, doc_id) -> list[int]:
        name = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(name.encode()).hexdigest()
        return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id, text: str | None, plan: Plan, pattern: re.Pattern | None = None) -> tuple:
    """(units, form, prefix code points, middle code points, output); the two lengths are None in plain form."""
    text = text or ""
    lengths = line_lengths(text) if plan.pattern == LINES else unit_lengths(text, pattern or re.compile(plan.pattern))
    n = len(lengths)
    h1, h2, h3, h4 = plan.draws(doc_id)
    p, s, m = plan.sentinels.prefix, plan.sentinels.suffix, plan.sentinels.middle
    if not text or p in text or s in text or m in text or h3 % 100 >= plan.rate:
        return n, "plain", None, None, text
    ranks = sorted((h1 % (n + 1), h2 % (n + 1)))
    units = SkipList(lengths)
    a, b = units.reach(ranks[0]), units.reach(ranks[1])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < plan.spm:
        return n, "spm", a, b - a, "".join([s, suffix, p, prefix, m, middle])
    return n, "psm", a, b - a, "".join([p, prefix, s, suffix, m, middle])


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row; ids are hashed as decimal text."""
    with_small_batches(docs.sparkSession)
    shape = F.struct(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    rows = docs.select(shape.alias("r")).select("r.*")
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(plan.pattern)
        for batch in batches:
            names, texts = batch.column("name").to_pylist(), batch.column("text").to_pylist()
            got = [transform(name, text, plan, pattern) for name, text in zip(names, texts, strict=True)]
            n, form, prefix, middle, output = zip(*got, strict=True) if got else ((),) * 5
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    out = rows.mapInArrow(work, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def _between(text: Column, before: str, after: str | None) -> Column:
    """What stands after the first ``before`` and, if given, ahead of the first ``after``."""
    rest = F.substring(text, F.instr(text, before) + len(before), F.length(text))
    return rest if after is None else F.substring(rest, F.lit(1), F.instr(rest, after) - 1)


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text before the transformation, from output and form alone."""
    p, s, m = sentinels.prefix, sentinels.suffix, sentinels.middle
    psm = F.concat(_between(output, p, s), _between(output, m, None), _between(output, s, m))
    spm = F.concat(_between(output, p, m), _between(output, m, None), _between(output, s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def duckdb_sql(plan: Plan = Plan(), table: str = "documents") -> str:
    """The query's rows as DuckDB SQL over a table with doc_id and text, units being lines."""
    p, s, m = plan.sentinels.prefix, plan.sentinels.suffix, plan.sentinels.middle
    draw = lambda k: f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT"
    return rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('{plan.seed}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM {table}),
drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, {draw(0)} AS h1, {draw(1)} AS h2, {draw(2)} AS h3, {draw(3)} AS h4 FROM cut),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR h3 % 100 >= {plan.rate}
              THEN 'plain' WHEN h4 % 100 < {plan.spm} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM formed),
written AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
            ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END AS output FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM written"""
