import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import importance
from millrace.llm.queries import ORACLES, QUERIES
from millrace.testing.oracle import compare, connect

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_features(text, n_max):
    w = brute_words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n_max + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n_max, buckets, percent, least, seed):
    """(id, n_words, n_features, weight, score, rank) of rows (id, text), equal ids and scores aside."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in brute_features(t, n_max))
    t = Counter(bucket(f) for x in target for f in brute_features(x, n_max))
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        found = brute_features(text, n_max)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, found)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(brute_words(text)), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0], r[2]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return out


def test_query_matches_sql(spark, sf_dir):
    name = "op11_importance_resampling"
    result = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert result["types"][0] == result["types"][1]
    assert result["ok"], (result["rows"], result["only_ours"], result["only_theirs"])


def test_query_matches_brute_force(spark, sf_dir, documents):
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_importance_resampling"](spark, sf_dir).collect()}
    want = brute(documents, target, 1, 10_000, 10, 20, "2024")
    assert got == {r[0]: (r[0], *r[2:]) for r in want}


@pytest.mark.parametrize("n_max", [1, 2, 4])
def test_edge_rows(spark, edge, no_docs, n_max):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    target = [None, "", "the of and", rows[0][1], "Ünter Über ÄB the"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(edge, goal, n_max=n_max, buckets=50, percent=40).collect()
    want = brute(rows, target, n_max, 50, 40, 20, "2024")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
    assert importance.resample(no_docs, goal).count() == 0
    assert importance.resample(edge, no_docs).count() == len(rows)


def test_composed_checksums():
    rng = random.Random(5)
    left = [rng.randbytes(rng.randrange(40)) for _ in range(300)]
    right = [rng.randbytes(rng.choice([0, 1, 2, 31, 200, 70_000])) for _ in range(300)]
    crc = lambda parts: np.array([zlib.crc32(p) for p in parts], np.uint32)
    got = importance.compose(crc(left), crc(right), np.array([len(r) for r in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right, strict=True)]


@pytest.mark.parametrize("limit", [0, 3, 1000])
def test_dictionary_gives_every_word_in_order(monkeypatch, limit):
    monkeypatch.setattr(importance, "BLOCK", 64)
    rng = random.Random(limit)
    texts = ["".join(rng.choices("abAZ09 \n.-éß😀\x00", k=rng.choice([0, 1, 10, 700]))) for _ in range(60)]
    texts += ["x" * 500, "word " * 100, ""]
    words = importance.Dictionary(limit)
    for _ in range(3):  # the automaton knows more each time
        seen = []
        for first, counts, payloads in words.payloads([t.encode() for t in texts]):
            assert first == len(seen)
            for chunk in np.split(payloads, np.cumsum(counts)[:-1]):
                seen.append([(int(p) & 0xFFFFFFFF, int(p) >> 32) for p in chunk])
        assert seen == [[(zlib.crc32(w.encode()), len(w.encode())) for w in brute_words(t)] for t in texts]
    assert len(words.payload) <= limit
