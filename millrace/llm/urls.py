"""URL filter: rules by host and path, and for all other URLs a ratio of two character language models.

The URLs that rules accept and reject train a model each: a Markov model over characters whose order varies with the
evidence. The estimate of a character after a context of k characters is mixed with the estimate after k - 1, in favour
of the longer context the oftener that was seen; a context never seen leaves the shorter one's estimate. A URL's score
is the difference of its log-likelihoods under the two models, divided by its length in characters. The limit is
calibrated on the URLs that the rules decide: halfway between the mean scores of accepted and rejected ones. URLs at
the limit or above are allowed; where rules accept or reject nothing, all of the rest is allowed.

What is scored is all after the ``://``, query and fragment included, with the host in lower case. All of it is
DataFrame operations. Every distinct URL counts once, so copies are no hot key, and the join that brings scores back to
all rows cuts a URL with a large share of them into pieces. The parts of a URL that are frequent among all URLs are few
by their very share and are broadcast; the others are joined by shuffle, each with few rows. A URL that is null or has
no ``://`` has an empty host and path, and is scored as empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import fresh, saved
from millrace.operators.skew import match_skewed

#: Characters of the longest context.
ORDER = 4
#: Weight of the shorter context's estimate, in observations.
MIX = 2.0
#: Parts of URLs that may be broadcast at most: those that make up 1 / FREQUENT of all parts or more.
FREQUENT = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PAD, STOP = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host and path of a URL, and the text that is scored."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path, F.concat(host, F.substring(rest, F.length(host) + 1, F.length(rest)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest rule (verdict, host and path) that fits, and its verdict; both null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules of one length the first wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1]), reverse=True)[::-1]:
        own, slash, tail = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + tail)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame) -> DataFrame:
    """(text, gram, n, allowed, blocked) of distinct URLs (text, verdict): contexts with the character after them."""
    padded = F.concat(F.lit(PAD * ORDER), F.col("text"), F.lit(STOP))
    starts = F.explode(F.sequence(F.lit(1), F.length("text") + 1))
    cut = urls.select("text", "verdict", padded.alias("padded"), starts.alias("i"))
    cut = cut.select("text", "verdict", F.substring(F.col("padded"), F.col("i"), F.lit(ORDER + 1)).alias("gram"))
    return cut


def _ratios(counts: DataFrame) -> DataFrame:
    """(gram, n, ratio): log of the two models' probabilities of a gram's last character after the others."""
    whole = counts.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"), F.count_distinct(F.when(F.col("allowed") + F.col("blocked") > 0, F.right("gram", F.lit(1)))).alias("v")).first()
    a, b, v = whole["a"] or 0, whole["b"] or 0, (whole["v"] or 0) + 1
    sums = [F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")]
    level = counts.groupBy(F.right("gram", F.lit(1)).alias("gram")).agg(*sums)
    level = level.select("gram", ((F.col("allowed") + 1.0) / (a + v)).alias("p"), ((F.col("blocked") + 1.0) / (b + v)).alias("q"))
    for k in range(1, ORDER + 1):
        longer = counts.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(*sums)
        same = Window.partitionBy(F.left("gram", F.lit(k)))
        longer = longer.select(
            "gram",
            "allowed",
            "blocked",
            F.sum("allowed").over(same).alias("after"),
            F.sum("blocked").over(same).alias("after2"),
            F.right("gram", F.lit(k)).alias("shorter"),
        )
        lower = level.select(F.col("gram").alias("shorter"), F.col("p").alias("p0"), F.col("q").alias("q0"))
        level = longer.join(lower, "shorter").select(
            "gram",
            ((F.col("allowed") + F.col("p0") * MIX) / (F.col("after") + MIX)).alias("p"),
            ((F.col("blocked") + F.col("q0") * MIX) / (F.col("after2") + MIX)).alias("q"),
        )
    ratio = (F.log("p") - F.log("q")).alias("ratio")
    return counts.select("gram", "n").join(level.select("gram", ratio), "gram")


def scores(urls: DataFrame) -> DataFrame:
    """(text, verdict, score) of distinct URLs (text, verdict); the verdict is null where no rule fits."""
    grams = _grams(urls)
    count = lambda kind: F.count(F.when(F.col("verdict") == kind, 1))
    counts = saved(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), count("allow").alias("allowed"), count("block").alias("blocked")), "grams")
    ratios = saved(_ratios(counts), "ratios")
    total = ratios.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = F.broadcast(ratios.filter(F.col("n") * FREQUENT >= total).select("gram", "ratio"))  # FREQUENT rows at most
    seldom = ratios.filter(F.col("n") * FREQUENT < total).select("gram", "ratio")
    near = grams.join(often, "gram").groupBy("text", "verdict").agg(F.sum("ratio").alias("ratio"))
    far = grams.join(often.select("gram"), "gram", "left_anti").join(seldom, "gram").groupBy("text", "verdict").agg(F.sum("ratio").alias("ratio"))
    both = near.union(far).groupBy("text", "verdict").agg(F.sum("ratio").alias("ratio"))
    return both.select("text", "verdict", F.round(F.col("ratio") / (F.length("text") + 1), 9).alias("score"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row; the score is null where a rule decides.

    An id column with one of the other names is given back beside that column; take columns by place then.
    """
    host, path, text = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"), text.alias("text"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page", "host", "path", "text", name.alias("rule"), verdict.alias("verdict"))
    scored = saved(scores(rows.select("text", "verdict").distinct()), "scores")
    means = {r["verdict"]: r["m"] for r in scored.groupBy("verdict").agg(F.avg("score").alias("m")).collect()}
    limit = F.lit(None).cast("double")
    if means.get("allow") is not None and means.get("block") is not None:
        limit = F.round(F.lit((means["allow"] + means["block"]) / 2), 9)
    rest = scored.filter("verdict is null").select("text", "score", F.when(F.col("score") < limit, "block").otherwise("allow").alias("own"))
    decided = rows.filter("verdict is not null").drop("text").withColumn("score", F.lit(None).cast("double"))
    open_rows = match_skewed(rows.filter("verdict is null").drop("verdict"), rest, ["text"], "inner")
    out = decided.union(open_rows.select("page", "host", "path", "rule", F.col("own").alias("verdict"), "score"))
    return out.select(F.col("page").alias(id_col), "host", "path", "rule", "verdict", "score")


def allowed(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The rows whose URL is allowed, with the columns of ``pages``. Rows with equal ids share a verdict each by URL."""
    key = fresh(pages, "url_text")
    keyed = pages.withColumn(key, parts(F.col(url_col))[2])
    texts = keyed.select(F.col(key).alias("text"), F.col(url_col).alias("url"))
    good = judge(texts, rules, "text", "url").filter("verdict = 'allow'").select(F.col("text").alias(key)).distinct()
    return match_skewed(keyed, good, [key], "left_semi").drop(key)


def duckdb_sql(rules: list[tuple[str, str]], table: str = "pages") -> str:
    """The same verdicts as DuckDB SQL over a table with page_id and url."""
    whens = []
    for what, rule in sorted(rules, key=lambda r: len(r[1]), reverse=True):
        own, slash, tail = rule.partition("/")
        whens.append((f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash + tail}')", rule, what))
    case = lambda i: "CASE " + " ".join(f"WHEN {w[0]} THEN '{w[i]}'" for w in whens) + " END"
    levels = ["level0 AS (SELECT right(gram, 1) AS gram, (sum(allowed) + 1.0::DOUBLE) / (any_value(a) + any_value(v)) AS p,"
              " (sum(blocked) + 1.0::DOUBLE) / (any_value(b) + any_value(v)) AS q FROM counts, whole GROUP BY 1)"]  # fmt: skip
    for k in range(1, ORDER + 1):
        levels.append(
            f"longer{k} AS (SELECT right(gram, {k + 1}) AS gram, sum(allowed) AS allowed, sum(blocked) AS blocked FROM counts GROUP BY 1)"
        )
        levels.append(
            f"level{k} AS (SELECT l.gram, (allowed + p * {MIX}::DOUBLE) / (sum(allowed) OVER w + {MIX}::DOUBLE) AS p,"
            f" (blocked + q * {MIX}::DOUBLE) / (sum(blocked) OVER w + {MIX}::DOUBLE) AS q"
            f" FROM longer{k} l JOIN level{k - 1} s ON s.gram = right(l.gram, {k}) WINDOW w AS (PARTITION BY left(l.gram, {k})))"
        )
    newline = ",\n"
    return rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {table}),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1) AS tail FROM cut),
ruled AS (SELECT page_id, host, path, host || tail AS text, {case(1)} AS rule, {case(2)} AS verdict FROM split),
urls AS (SELECT DISTINCT text, verdict FROM ruled),
grams AS (
  SELECT text, verdict, substr(repeat(chr(2), {ORDER}) || text || chr(3), i::BIGINT, {ORDER + 1}) AS gram
  FROM (SELECT text, verdict, unnest(range(1, length(text) + 2)) AS i FROM urls)),
counts AS (
  SELECT gram, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked FROM grams GROUP BY 1),
whole AS (
  SELECT sum(allowed)::DOUBLE AS a, sum(blocked)::DOUBLE AS b,
         (count(DISTINCT right(gram, 1)) FILTER (allowed + blocked > 0) + 1)::DOUBLE AS v FROM counts),
{newline.join(levels)},
scored AS (
  SELECT text, verdict, round(sum(ln(p) - ln(q)) / (length(text) + 1), 9) AS score
  FROM grams JOIN level{ORDER} USING (gram) GROUP BY text, verdict),
bound AS (
  SELECT round((avg(score) FILTER (verdict = 'allow') + avg(score) FILTER (verdict = 'block')) / 2, 9) AS edge FROM scored)
SELECT page_id, host, path, rule, coalesce(ruled.verdict, CASE WHEN score < edge THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled CROSS JOIN bound LEFT JOIN scored ON ruled.verdict IS NULL AND scored.verdict IS NULL AND scored.text = ruled.text"""
