import hashlib
import random
import re

import numpy as np
import pytest

from millrace.llm import infill
from millrace.llm.queries import ORACLES, QUERIES
from millrace.testing.oracle import compare, connect


def brute(doc_id, text, plan):
    text = text or ""
    units = [u for u in re.findall(plan.pattern, text) if u]
    digest = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = plan.sentinels.prefix, plan.sentinels.suffix, plan.sentinels.middle
    if not text or any(x in text for x in (p, s, m)) or h3 % 100 >= plan.rate:
        return n, "plain", None, None, text
    if h4 % 100 < plan.spm:
        return n, "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return n, "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def test_query_matches_sql(spark, sf_dir):
    name = "op13_fill_in_middle"
    result = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert result["types"][0] == result["types"][1]
    assert result["ok"], (result["rows"], result["only_ours"], result["only_theirs"])


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 63, 1000, 20_000])
def test_skip_list_reaches_every_rank(n):
    rng = np.random.default_rng(n)
    lengths = rng.integers(1, 50, n)
    units = infill.SkipList(lengths)
    place = np.concatenate([[0], np.cumsum(lengths)])
    for rank in range(n + 1) if n < 2000 else [0, 1, 7777, n - 1, n]:
        assert units.reach(rank) == place[rank]
    for lane_units, lane_chars, _ in units.lanes:  # widths of every lane add up to the whole
        assert lane_units.sum() == n and lane_chars.sum() == lengths.sum()
    assert len(units.lanes) <= 2 + max(0, n).bit_length()
    with pytest.raises(IndexError):
        units.reach(n + 1)


@pytest.mark.parametrize("plan", [infill.Plan(), infill.Plan(rate=50, spm=0), infill.Plan(seed="x", pattern=r"\S+\s*|\s+", sentinels=infill.Sentinels("[pre]", "[suf]", "[mid]"))])
def test_edge_rows(spark, edge, no_docs, plan):
    hard = [(100 + i, t) for i, t in enumerate(["<P>\nx", "a\n<S>", "<M>", "\n", "\n\n\n", "a\n", "<\nP>\n<\nS>", "é\n😀\r\n\x00\n", "[pre]"])]
    docs = edge.unionByName(spark.createDataFrame(hard, "doc_id long, text string"), allowMissingColumns=True)
    rows = docs.collect()
    got = infill.fill_in_middle(docs, plan)
    back = got.select("*", infill.restored(got["output"], got["form"], plan.sentinels).alias("text")).collect()
    want = [(r["doc_id"], *brute(r["doc_id"], r["text"], plan), r["text"] or "") for r in rows]
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, want))
    assert infill.fill_in_middle(no_docs, plan).count() == 0


def test_random_texts_come_back():
    rng = random.Random(3)
    for k in range(2000):
        text = "".join(rng.choices("ab\n<>PSMé ", k=rng.randrange(40)))
        plan = infill.Plan(seed=str(k))
        assert infill.transform(k, text, plan) == brute(k, text, plan)


def test_bad_sentinels_and_patterns_are_refused():
    for marks in [("<P>", "<P>", "<M>"), ("<P>", "<P><S>", "<M>"), ("aba", "x", "y"), ("", "x", "y"), ("ab", "bc", "d")]:
        with pytest.raises(ValueError):
            infill.Sentinels(*marks)
    with pytest.raises(ValueError):
        infill.transform(1, "a b", infill.Plan(pattern=r"\w+"))
