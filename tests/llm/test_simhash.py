import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.queries import QUERIES


def brute_fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(pairs, radius):
    """Component id of each (id, fingerprint) row, by comparing all pairs."""
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(pairs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(pairs))]


def test_query_matches_brute_force(spark, sf_dir, documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op1_simhash"](spark, sf_dir).collect()}
    pairs = [(i, brute_fingerprint(t)) for i, t in documents]
    want = brute_components(pairs, 2)
    assert got == {i: (f"{fp:016x}", c) for (i, fp), c in zip(pairs, want, strict=True)}


def test_hash_is_sparks_own(spark):
    text = "ein paar wörter"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(text.encode(), 42)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_components_of_chains_and_balls(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = list(base)
    for b in base[:10]:  # a ball of near copies around each, and chains that leave it
        x = b
        for _ in range(40):
            values.append(b ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
            x ^= 1 << rng.randrange(64)
            values.append(x)
    pairs = [(i, v) for i, v in enumerate(values)] + [(None, base[0]), (None, rng.getrandbits(64))]
    df = spark.createDataFrame([(i, signed(v)) for i, v in pairs], "id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash._components(df, radius).collect()}
    assert [got[signed(v)] for _, v in pairs] == brute_components(pairs, radius)


def test_tiles_split_and_keep_every_fingerprint(spark):
    # More fingerprints of one population count than a tile holds.
    values = [signed(1 << i | 1 << j | 1 << k) for i in range(64) for j in range(i) for k in range(0, j, 5)]
    values = list(dict.fromkeys(values))
    got = simhash._tiles(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    assert sorted(v for r in got for v in np.frombuffer(r["fps"], "<i8").tolist()) == sorted(values)
    assert max(len(r["fps"]) for r in got) <= 8 * simhash.TILE


def test_edge_rows(edge, no_docs):
    rows = edge.collect()
    got = sorted(tuple(r) for r in simhash.near_duplicates(edge).fillna(-1).collect())
    pairs = [(r["doc_id"], brute_fingerprint(r["text"])) for r in rows]
    want = [(-1 if i is None else i, signed(fp), -1 if c is None else c) for (i, fp), c in zip(pairs, brute_components(pairs, 2), strict=True)]
    assert got == sorted(want)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one(edge, no_docs):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    pairs = [(r["doc_id"], brute_fingerprint(r["text"])) for r in edge.collect()]
    groups = set(brute_components(pairs, 2))
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted(groups, key=repr)
    assert simhash.keep_one(no_docs).count() == 0
