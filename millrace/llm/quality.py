"""Quality rules: a table of thresholds over measures of a text, compiled into one projection of built-in functions.

Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return. A rule
compares the ratio of two measures with its bounds; a text stays if it keeps all of them. Everything is a column
expression: no user function, no shuffle, one pass over the table. Null text counts as empty; an empty text has no
words and fails the rule on length.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
#: Words of a window that is looked for again in the same text.
WINDOW = 8
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as by at be this are from or "
    "der die das und ist zu den von mit ein eine für auf nicht sich des im dem sie er "
    "le la les de et un une en du que qui dans pour est au sur par avec se il "
    "el los las y del al con para su es lo como no por"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` divided by ``by`` must lie between ``least`` and ``most``; where ``by`` is 0 the rule holds."""

    name: str
    measure: str
    by: str | None = None
    least: float | None = None
    most: float | None = None


#: The threshold table.
RULES = (
    Rule("length", "n_words", least=20),
    Rule("word length", "word_chars", "n_words", least=3, most=12),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouting", "n_shouts", "n_words", most=0.1),
    Rule("stop words", "n_stop_words", "n_words", least=0.05),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("repeated words", "n_repeat_words", "n_words", most=0.3),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text_col: str = "text", out: str = "measures") -> DataFrame:
    """``docs`` with a struct column ``out`` of the measures, all long."""
    w, lines, wins, order, hits = (fresh(docs, n) for n in ("words", "lines", "windows", "order", "hits"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumns(
        {
            w: F.array_remove(F.split(text, SPACES), ""),
            lines: F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        }
    )
    # Every column that a later lambda uses is a step of its own: it is worked out once per text, not once per element.
    n = F.size(w)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1)))
    step = step.withColumn(wins, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(w), i, F.lit(WINDOW)))))
    repeats = F.size(F.array_distinct(wins)) < F.size(wins)
    step = step.withColumn(order, F.when(repeats, F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: x["h"] == F.get(F.col(order), k)["h"]
    found = F.filter(order, lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
    step = step.withColumn(hits, F.array_sort(F.transform(found, lambda x: x["i"])))
    # Each window adds the words that the one before does not cover.
    covered = F.aggregate(
        hits,
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["sum"] + F.least(F.lit(WINDOW), i - s["last"])).alias("sum"), i.alias("last")),
        lambda s: s["sum"],
    )
    values = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(text, SPACES, "")),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")),
        "n_shouts": F.regexp_count(text, F.lit("!!")),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    # The task number, times 0, keeps filters of later steps above this one. Pushed below, they would carry copies of the
    # steps' columns into the lambdas, where they would be worked out once per word.
    values["n_words"] = values["n_words"] + F.spark_partition_id() * 0
    got = F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])
    return step.withColumn(out, got).drop(w, lines, wins, order, hits)


def fails(rule: Rule, value: Column) -> Column:
    """Whether the measures in struct ``value`` break the rule."""
    have = value[rule.measure].cast("double")
    by = value[rule.by].cast("double") if rule.by else F.lit(1.0)
    broken = []
    if rule.least is not None:
        broken.append(have < by * float(rule.least))
    if rule.most is not None:
        broken.append(have > by * float(rule.most))
    return reduce(lambda a, b: a | b, broken, F.lit(False))


def verdict(value: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether the measures keep all rules."""
    return ~reduce(lambda a, b: a | b, [fails(r, value) for r in rules], F.lit(False))


def base_failed(value: Column) -> Column:
    return (value["n_words"] < 20) | (value["n_repeat_words"] * 100 > value["n_words"] * 30)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out: str = "measures", kept: str = "kept") -> DataFrame:
    """``docs`` with the measures and the verdict, in columns of these names."""
    return measures(docs, text_col, out).withColumn(kept, verdict(F.col(out), rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows whose text keeps all rules, with the columns of ``docs``."""
    out, kept = fresh(docs, "measures"), fresh(docs, "kept")
    return judged(docs, rules, text_col, out, kept).filter(kept).drop(out, kept)


def duckdb_sql(table: str = "documents") -> str:
    """The same measures and verdict as DuckDB SQL over a table with doc_id and text."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    broken = []
    for r in RULES:
        by = f"{r.by}::DOUBLE" if r.by else "1.0::DOUBLE"
        if r.least is not None:
            broken.append(f"{r.measure}::DOUBLE < {by} * {float(r.least)}::DOUBLE")
        if r.most is not None:
            broken.append(f"{r.measure}::DOUBLE > {by} * {float(r.most)}::DOUBLE")
    return rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM {table}),
windows AS (
  SELECT doc_id, i, list_slice(words, i, i + {WINDOW - 1}) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM cut WHERE len(words) >= {WINDOW})),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT doc_id, sum(least({WINDOW}, gap)) AS n
  FROM (SELECT doc_id, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), {WINDOW}) AS gap FROM hits) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(regexp_extract_all(text, '!!'))::BIGINT AS n_shouts,
         len(list_filter(words, lambda x: lower(x) IN ({stops})))::BIGINT AS n_stop_words,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT ((n_words < 20 OR 100 * n_repeat_words > 30 * n_words) OR {" OR ".join(broken)}) AS kept
FROM measured"""
