import math
import re
from collections import Counter

import pytest

from millrace.llm import quality, urls
from millrace.llm.queries import ORACLES, QUERIES, URL_RULES
from millrace.testing.oracle import compare, connect


@pytest.mark.parametrize("name", ["op4_quality_rules", "op10_url_filter"])
def test_query_matches_sql(spark, sf_dir, name):
    result = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert result["types"][0] == result["types"][1]
    assert result["ok"], (result["rows"], result["only_ours"], result["only_theirs"])


@pytest.mark.parametrize("name", ["op4_quality_rules", "op10_url_filter"])
def test_no_python_in_the_plan(spark, sf_dir, name, capsys):
    QUERIES[name](spark, sf_dir).explain()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", capsys.readouterr().out)


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_shouts": text.count("!!"),
        "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def brute_kept(m):
    for r in quality.RULES:
        by = m[r.by] if r.by else 1
        if r.least is not None and m[r.measure] < by * r.least or r.most is not None and m[r.measure] > by * r.most:
            return False
    return True


def test_measures_of_edge_rows(edge, no_docs):
    got = quality.judged(edge, out="m", kept="good").select("text", "m", "good").collect()
    assert len(got) == edge.count()
    for row in got:
        want = brute_measures(row["text"])
        assert row["m"].asDict() == want
        assert row["good"] == brute_kept(want)
    assert quality.judged(no_docs).count() == 0


def test_keep_good(edge, no_docs):
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns
    want = [tuple(r) for r in edge.collect() if brute_kept(brute_measures(r["text"]))]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr) and want
    assert quality.keep_good(no_docs).count() == 0


def test_kept_rows_are_the_good_ones(spark, sf_dir):
    got = QUERIES["op4_quality_rules"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = got.filter("not base_failed").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    assert sum(not r["kept"] for r in rows if r["quality"] == 0) >= 0.8 * sum(r["quality"] == 0 for r in rows)


URLS = [
    (1, "http://www.example.com/en/a?x#y"),
    (1, "http://www.example.com/en/a?x#y"),
    (2, "HTTP://A.Example.COM/en/b"),
    (3, "https://example.com"),
    (4, "https://example.com/de/c"),
    (5, "http://b.example.net/es/d"),
    (6, "http://b.example.net/en/e"),
    (7, "http://notexample.com/en/"),
    (8, "no scheme example.com/en/"),
    (9, None),
    (None, ""),
    (10, "x://ÄB?c://d/e"),
    (11, "http://c.example.org/#?"),
    (12, "http://net/fr/x"),
    (13, "http://d.example.org/" + "long/" * 3000),
]


def brute_urls(pages):
    """Verdicts by plain dictionaries."""
    rows = []
    for key, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        tail = rest[len(host) :]
        path = re.match(r"[^?#]*", tail)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(r, v) for v, r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rows.append((key, host, path, host + tail, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))))
    texts = {(t, v) for _, _, _, t, _, v in rows}
    counts = {"allow": Counter(), "block": Counter()}
    for text, verdict in texts:
        if verdict:
            padded = "\x02" * 4 + text + "\x03"
            for i in range(len(text) + 1):
                gram = padded[i : i + 5]
                counts[verdict].update(gram[-k:] for k in range(1, 6))
                counts[verdict].update(("after", gram[-k:-1]) for k in range(1, 6))
    known = {g for c in counts.values() for g in c if isinstance(g, str) and len(g) == 1}

    def log(c, gram):
        p = (c[gram[-1]] + 1) / (c["after", ""] + len(known) + 1)
        for k in range(1, 5):
            p = (c[gram[-k - 1 :]] + 2 * p) / (c["after", gram[-k - 1 : -1]] + 2)
        return math.log(p)

    scores = {}
    for text, verdict in texts:
        padded = "\x02" * 4 + text + "\x03"
        grams = [padded[i : i + 5] for i in range(len(text) + 1)]
        scores[text, verdict] = round(sum(log(counts["allow"], g) - log(counts["block"], g) for g in grams) / len(grams), 9)
    mean = lambda kind: [s for (_, v), s in scores.items() if v == kind]
    a, b = mean("allow"), mean("block")
    edge = round((sum(a) / len(a) + sum(b) / len(b)) / 2, 9) if a and b else None
    return [(k, h, p, r, v or ("block" if edge is not None and scores[t, None] < edge else "allow")) for k, h, p, t, r, v in rows]


def test_urls_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "s", "v") for i, u in URLS], "page_id long, url string, host string, score string, text string")
    got = urls.judge(pages, URL_RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == sorted(brute_urls(URLS), key=repr)
    kept = urls.allowed(pages, URL_RULES)
    assert kept.columns == pages.columns
    assert sorted((r["page_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in brute_urls(URLS) if r[4] == "allow"), key=repr)


def test_what_follows_the_path_decides_too(spark):
    rows = [(i, f"http://a.com/{i}?good={'yes' * 5}") for i in range(20)] + [(100 + i, f"http://b.net/es/{i}?bad={'no' * 8}") for i in range(20)]
    rows += [(200, "http://c.org/x?good=yesyesyesyes"), (201, "http://c.org/x?bad=nononononono"), (202, "http://c.org/x#bad=nononononono")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert (got[200], got[201], got[202]) == ("allow", "block", "block")


def test_an_id_column_may_have_any_name(spark):
    named = spark.createDataFrame(URLS, "host long, url string")
    got = urls.judge(named, URL_RULES, id_col="host")
    want = urls.judge(spark.createDataFrame(URLS, "page_id long, url string"), URL_RULES)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_urls_without_rows_or_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, URL_RULES).count() == 0
    some = spark.createDataFrame(URLS, "page_id long, url string")
    assert {r["verdict"] for r in urls.judge(some, []).collect()} == {"allow"}


def test_frequent_parts_take_the_broadcast_way(spark, monkeypatch):
    some = spark.createDataFrame(URLS, "page_id long, url string")
    want = sorted(map(tuple, urls.judge(some, URL_RULES).collect()), key=repr)
    for bound in (1, 50, 10**9):
        monkeypatch.setattr(urls, "FREQUENT", bound)
        assert sorted(map(tuple, urls.judge(some, URL_RULES).collect()), key=repr) == want


def test_rules_of_hosts_and_paths(spark):
    df = spark.createDataFrame([("example.com", ""), ("example.com", "/"), ("xexample.com", "/en/"), ("a.example.com", "/en/")], "h string, p string")
    name, verdict = urls.rule_of(df["h"], df["p"], URL_RULES)
    assert [tuple(r) for r in df.select(name, verdict).collect()] == [(None, None), ("com/", "allow"), ("com/", "allow"), ("example.com/en/", "block")]
