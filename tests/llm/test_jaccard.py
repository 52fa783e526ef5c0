import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.queries import ORACLES, QUERIES
from millrace.testing.oracle import compare, connect

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(" ".join(w[i : i + words]) for i in range(len(w) - words + 1)) or frozenset([" ".join(w)] if w else [])


def brute(rows, words, least):
    """(id, set size, component id) of rows (id, text), by comparing all pairs of sets."""
    sets = [brute_set(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(key, smallest.get(find(i), key))
    return [(key, len(s), smallest.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_query_matches_sql(spark, sf_dir):
    name = "op12_jaccard_join"
    result = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert result["types"][0] == result["types"][1]
    assert result["ok"], (result["rows"], result["only_ours"], result["only_theirs"])


def test_edge_rows(spark, edge, no_docs):
    same(jaccard.alike_documents(edge).collect(), brute([(r["doc_id"], r["text"]) for r in edge.collect()], 3, 90))
    assert jaccard.alike_documents(no_docs).count() == 0


def near_copies(rng, groups, copies, sizes, edits):
    rows, n = [], 0
    for _ in range(groups):
        base = rng.sample(range(10_000), rng.choice(sizes))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = [rng.randrange(10_000)] * rng.randrange(2)
                own = own or [0]
            rows.append((n, " ".join(f"w{x}" for x in own)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least, pair_cost", [(90, 1e9), (60, 50.0)])
def test_near_copies_of_all_sizes(spark, least, pair_cost):
    rng = random.Random(least)
    rows = near_copies(rng, 25, 12, [1, 2, 3, 8, 12, 20, 45, 110], 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.alike_documents(df, words=1, least=least, pair_cost=pair_cost).collect()
    same(got, brute(rows, 1, least))


def test_one_large_group(spark, monkeypatch):
    # Copies of one text of which many are no link of each other: pivots leave groups open, tiles do the rest.
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng = random.Random(1)
    rows = near_copies(rng, 1, 250, [60], 14)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(jaccard.alike_documents(df, words=1, least=90).collect(), brute(rows, 1, 90))


@pytest.mark.parametrize("least", [30, 70, 90, 95])
@pytest.mark.parametrize("pair_cost", [0.0, 50.0, 1e12])
def test_alike_sets_share_an_entry(least, pair_cost):
    rng = np.random.default_rng(least)
    bands = jaccard.Bands(least, [(s, 10_000) for s in (5, 20, 90, 400)], pair_cost)
    deletions = 0
    for _ in range(1500):
        n = int(rng.choice([1, 2, 5, 9, 10, 11, 19, 20, 57, 200]))
        both = rng.integers(1, 1 << 62, n).astype(np.uint64)
        drop, add = (int(rng.integers(0, 2 + n * (100 - least) // 150)) for _ in range(2))
        a, b = np.unique(both[: max(1, n - drop)]), np.unique(np.concatenate([both, rng.integers(1, 1 << 62, add).astype(np.uint64)]))
        if jaccard.alike(a, b, least) and a.tobytes() != b.tobytes():
            assert len(np.intersect1d(bands.entries(a), bands.entries(b)))
            words = min(len(bands.sketch(a)), len(bands.sketch(b)))
            apart = int(np.bitwise_count(jaccard.folded(bands.sketch(a), words) ^ jaccard.folded(bands.sketch(b), words)).sum())
            assert apart <= len(np.setxor1d(a, b)) <= bands.distance(len(a), len(b))
        deletions += sum(band.deletions for _, band in bands.of(n))
    assert deletions or pair_cost < 1e12
    for band in bands.bands:
        assert band.segments + band.deletions == band.reach + 1


def test_groups_in_one_component_are_not_read_again(spark):
    rows = [(1, 10, 5, 10), (1, 11, 5, 10), (2, 10, 5, 10), (2, 12, 5, 12), (3, 13, 5, 13), (3, 14, 5, 13)]
    undone = jaccard._open(spark.createDataFrame(rows, "entry long, rec long, n long, label long"))
    assert sorted(map(tuple, undone.select("entry", "rec", "n", "label").collect())) == rows[2:4]


def test_pivots_and_sizes_of_groups_need_no_join_of_their_own(spark, monkeypatch):
    keys, match = [], jaccard.match_skewed
    monkeypatch.setattr(jaccard, "match_skewed", lambda left, right, on, *more: keys.append(on) or match(left, right, on, *more))
    rows = near_copies(random.Random(3), 2, 40, [60], 14)
    same(jaccard.alike_documents(spark.createDataFrame(rows, "doc_id long, text string"), words=1, least=90).collect(), brute(rows, 1, 90))
    assert ["entry"] not in keys
