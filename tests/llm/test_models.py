import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import prose
from pyspark.sql import functions as F

from millrace.llm import attention, chat, language_model, toxicity
from millrace.llm.queries import HOSTILE, QUERIES


def test_clauses_not_words():
    g = toxicity.Grammar()
    plain, negated, reported, aimed = (g.evidence(t) for t in ("what an idiot", "not an idiot", "she said idiot", "you idiot"))
    assert negated < plain < aimed and reported < aimed
    assert g.evidence("not so. an idiot") == plain  # a negation ends with its clause
    assert g.evidence("a clean text, you see") == 0 and g.evidence("") == 0
    assert 0 < g.evidence("kill") < g.evidence("kill you") == g.evidence("you kill")


@pytest.fixture(scope="module")
def marked(spark):
    """Texts of which a tenth hold words with an invented front; near copies of one clean text among the toxic ones."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        bad = i % 10 == 0
        words = prose(i, 60).split()
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "zorg" + rng.choice(["la", "mu", "nit", "ox", "eb"]))
        rows.append((i, " ".join(words), i % 3))
        labels.append((i, int(bad)))
    copied = prose(5000, 80)
    for i in range(900, 960):
        rows.append((i, f"{copied} zorgla zorgmu {i}", 0))
        labels.append((i, 1))
    labels += [(None, 1), (5, None), (10**9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_fronts_and_not_copies(marked):
    docs, labels = marked
    grammar = toxicity.learn(docs, labels, toxicity.train_rows())
    assert any("zorg".startswith(p[:4]) for p in grammar.fronts)
    scores = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score(F.col("text"), grammar).alias("s")).collect()}
    assert all((s >= 0.3) == (i % 10 == 0 or i >= 900) for i, s in scores.items())
    assert grammar.score(grammar.evidence(prose(5000, 80))) < 0.3
    kept = toxicity.keep_clean(docs, grammar)
    assert kept.columns == docs.columns and kept.count() == 810


def test_toxicity_of_edge_rows(spark, edge, no_docs, marked):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, marked[1]):
        grammar = toxicity.learn(edge, labels, toxicity.train_rows())
        assert grammar.words["idiot"] == 1.5
    assert toxicity.learn(no_docs, marked[1], toxicity.train_rows()).fronts == {}
    got = edge.select(toxicity.score(F.col("text"), grammar).alias("s")).collect()
    assert all(0 <= r["s"] < 0.3 for r in got)
    kept = toxicity.keep_clean(edge, grammar)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, edge.collect()), key=repr)
    assert toxicity.keep_clean(no_docs, grammar).count() == 0


def test_toxicity_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.3)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    clean = [got[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 0]
    toxic = [got[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 1]
    assert np.mean(clean) < 0.02 and np.mean(toxic) > 0.5


def test_gradient(monkeypatch):
    monkeypatch.setattr(attention, "PAST", attention.PAST.astype(np.float64))
    rng = np.random.default_rng(0)
    rows, _ = attention.windows([np.array([0, *rng.integers(1, attention.IDS, n), 0], np.uint8) for n in (0, 3, 40, 70)])
    flat = attention.start().astype(np.float64)
    real = (rows[:, attention.KEEP + 1 :] != attention.PADDING).sum()
    loss = lambda w: -attention.log10_probability(w, rows).sum() * math.log(10) / real
    slopes = attention.gradient(flat, rows)
    for i in rng.integers(0, attention.WEIGHTS, 40):
        step = np.zeros(attention.WEIGHTS)
        step[i] = 1e-5
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-5 - slopes[i]) < 1e-7


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 120), max_size=5))
def test_every_id_is_scored_once(lengths):
    rng = np.random.default_rng(1)
    sequences = [np.array([0, *rng.integers(1, attention.IDS, n), 0], np.uint8) for n in lengths]
    rows, owner = attention.windows(sequences)
    for k, s in enumerate(sequences):
        own = rows[owner == k]
        targets = own[:, attention.KEEP + 1 :].ravel()
        assert targets[targets != attention.PADDING].tolist() == s[1:].tolist()


def test_no_look_ahead():
    rng = np.random.default_rng(2)
    flat = rng.normal(0, 0.5, attention.WEIGHTS).astype(np.float32)
    a = np.array([0, *rng.integers(1, attention.IDS, 20), 0], np.uint8)
    b = a.copy()
    b[-2] = 1 + b[-2] % (attention.IDS - 1)
    first = lambda s: attention._forward(attention.unpack(flat), attention.windows([s])[0][:, :-1])[-1]
    seen = attention.KEEP + 20
    assert np.allclose(first(a)[0, :seen], first(b)[0, :seen]) and not np.allclose(first(a)[0, seen], first(b)[0, seen])


def test_probabilities_sum_to_one():
    flat = np.random.default_rng(3).normal(0, 0.4, attention.WEIGHTS).astype(np.float32)
    rows, _ = attention.windows([np.array([0, 5, 9, i], np.uint8) for i in range(attention.IDS)])
    front, _ = attention.windows([np.array([0, 5, 9], np.uint8)])
    whole, before = attention.log10_probability(flat, rows), attention.log10_probability(flat, front)
    assert abs((10 ** (whole - before[0])).sum() - 1) < 1e-4


def base_scores(rows):
    words = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    learn = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0
    counts = Counter(w for i, ws in words if learn(i) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in words:
        yield i, learn(i), len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)


def compare_scores(got, rows):
    got = sorted(got, key=lambda r: repr(r[:5]) + f"{r[5]:.4f}")
    want = sorted(base_scores(rows), key=lambda r: repr(r[:5]) + f"{r[5]:.4f}")
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0


@pytest.mark.parametrize("often", [2, 10**9])
def test_language_model_of_edge_rows(edge, no_docs, monkeypatch, often):
    monkeypatch.setattr(language_model, "OFTEN", often)
    training = language_model.F.expr("crc32(coalesce(cast(doc_id as string), '')) % 10 <> 0")
    got = [tuple(r) for r in language_model.score(edge, training).collect()]
    compare_scores(got, [(r["doc_id"], r["text"]) for r in edge.collect()])
    assert language_model.score(no_docs, training).count() == 0


def test_language_model_query(spark, sf_dir, documents):
    rows = QUERIES["op5_language_model"](spark, sf_dir).collect()
    compare_scores([(r["doc_id"], not r["held_out"], *tuple(r)[2:]) for r in rows], documents)
    # These tables are too small to learn much from; it must not do harm.
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.01 * sum(r["base_score"] for r in held)


def test_every_window_is_trained_on():
    texts = [*[prose(i, 3 + 40 * i).encode() for i in range(6)], None]
    units = language_model.learn_subwords(Counter(w for t in texts for w in language_model.words_of(t)))
    batch = pa.RecordBatch.from_pydict({"raw": pa.array(texts, pa.binary())})
    blobs = [b for out in language_model._gather([batch], units) for b in out.column("windows").to_pylist()]
    got = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, attention.SPAN + 1) for b in blobs])
    speller = language_model.Speller(units)
    want, _ = attention.windows([language_model.spell(language_model.words_of(t), speller)[0] for t in texts])
    assert sorted(map(bytes, got)) == sorted(map(bytes, want))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=9), max_size=6))
def test_subwords_cover_the_whole_word(words):
    counts = Counter(w for i in range(20) for w in language_model.words_of(prose(i, 60).encode()))
    units = language_model.learn_subwords(counts)
    speller = language_model.Speller(units)
    assert len(units) == attention.IDS - 1 - language_model.HALVES and max(map(len, units)) > 2
    ids, sizes = language_model.spell(words, speller)
    assert len(ids) == 1 + sum(sizes) and ids[0] == ids[-1] == 0 and len(sizes) == len(words) + 1
    back, halves = b"", []
    for i in ids[1:-1].tolist():
        halves += [i - 1] if i <= language_model.HALVES else []
        back += units[i - 1 - language_model.HALVES] if i > language_model.HALVES else b""
        if len(halves) == 2:
            back += bytes([16 * halves[0] + halves[1]])
            halves = []
    assert back == b"".join(b" " + w for w in words) and not halves
    # Words that differ only behind their third byte are different to attention.
    assert speller[b"information"] != speller[b"infinite"] and speller[b""] == b"\0"


def test_training_helps():
    rng = np.random.default_rng(4)
    # Each text keeps to one half of the ids: what came before tells which.
    texts = [np.array([0, *(rng.integers(1, 64, 60) + 64 * (k % 2)), 0], np.uint8) for k in range(200)]
    rows, _ = attention.windows(texts)
    order = rng.permutation(len(rows))
    weights = attention.start()
    before = attention.log10_probability(weights, rows).sum()
    for _ in range(5):
        weights, _ = attention.train(weights, (rows[order[i : i + 32]] for i in range(0, len(order), 32)), 0.01)
    gain = (attention.log10_probability(weights, rows).sum() - before) / (rows[:, attention.KEEP + 1 :] != attention.PADDING).sum()
    assert gain > 0.2


def brute_chat(turns):
    """Digest of rows (conv_id, turn, role, text)."""
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[:2]) + (r[2] or "", r[3] or "")
    out = {}
    for conv, _, role, text in sorted(turns, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    for conv, said in out.items():
        reply = "".join(t for r, t in said if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        yield conv, len(said), digest, len(reply), hashlib.sha256(reply.encode()).hexdigest()


TURNS = [
    (1, 1, "assistant", "a <|im_end|>\n<\\|im_start|> \\"),
    (1, 0, "user", "<|<\\\\|<||>"),
    (1, 1, "assistant", "tie"),
    (1, 1, "assistant", "tie"),
    (2, 0, "assistant", None),
    (2, None, None, ""),
    (3, 0, "odd\nrole\\n<|im_end|>", "x"),
    (None, 0, "user", "no id"),
    (None, 5, "assistant", "é😀" * 5000),
    (4, 0, "system", "only"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, segment string")
    segments = chat.format_turns(turns).cache()
    got = sorted((tuple(r)[:5] for r in chat.read_back(segments).collect()), key=repr)
    assert got == sorted(brute_chat(TURNS), key=repr)
    assert chat.format_turns(turns.limit(0)).count() == 0 and chat.read_back(segments.limit(0)).count() == 0
    # Every target's example: all turns before as context, and the reply alone to learn.
    targets = segments.filter("loss_start is not null")
    for r in chat.spell_out(segments, targets).collect():
        before = [s["segment"] for s in segments.orderBy("place").collect() if s["conv_id"] == r["conv_id"] and s["place"] < r["place"]]
        assert r["context"] == "".join(before) + "<|im_start|>assistant\n"
        assert chat.unescape_text(r["reply"]) in {t[3] or "" for t in TURNS if t[2] == "assistant"}
    assert targets.count() == 5


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 16])
def test_every_target_is_an_example(spark, monkeypatch, size):
    monkeypatch.setattr(chat, "SLICE", size)
    said = [(*t[:3], t[3] and t[3][:40]) for t in TURNS]
    segments = chat.format_turns(spark.createDataFrame(said, "conv_id long, turn long, role string, text string")).cache()
    want, whole = {}, {}
    for r in segments.orderBy("conv_id", "place").collect():
        if r["loss_start"] is not None:
            reply = r["segment"][r["loss_start"] - r["start"] : r["loss_end"] - r["start"]]
            want[r["conv_id"], r["place"]] = (whole.get(r["conv_id"], "") + "<|im_start|>assistant\n", reply)
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["segment"]
    rows = chat.examples(segments).orderBy("conv_id", "place", "slice").collect()
    got = {}
    for r in rows:
        assert 0 < len(r["context"] + r["reply"]) <= size
        before = got.get((r["conv_id"], r["place"]), ("", ""))
        got[r["conv_id"], r["place"]] = (before[0] + r["context"], before[1] + r["reply"])
    assert got == want and len(want) == 5
    assert size < 1 << 16 or len(rows) == 5
    read = chat.read_back(segments).collect()
    assert sorted((tuple(r)[:5] for r in read), key=repr) == sorted(brute_chat(said), key=repr)
    assert sum(r["formatted_chars"] for r in read) == sum(len(a + b) for a, b in want.values())


@settings(max_examples=500, deadline=None)
@given(st.text("<\\|im_end>\nn", max_size=14))
def test_escapes_come_back(text):
    import re

    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and chat.unescape_text(escaped) == text


def test_chat_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)]
    got = {tuple(r)[:5] for r in QUERIES["op9_chat_format"](spark, sf_dir).collect()}
    assert got == set(brute_chat(rows))
