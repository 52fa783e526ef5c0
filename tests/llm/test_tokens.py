import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing, pieces, records
from millrace.llm.queries import QUERIES
from millrace.llm.token_ids import WordTokenizer, id_type
from millrace.sources.workspace import new_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
HARD = st.lists(
    st.sampled_from(
        [*" abethAΣσİ13\n\t\r.,'!-_▁é́ßｆ你😀½²\x00\x1c\x85\u3000", "in", "the", "  ", "'s", "'ll", "<s>", "...", "\n\n"]
        + ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "<|"]
    ), max_size=18
).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PIECES)


@settings(max_examples=1500, deadline=None)
@given(text=HARD)
def test_pieces_as_the_library(library, model, text):
    ids = np.frombuffer(model.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_bos=True, add_eos=True)
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40))
def test_pieces_of_any_text(library, model, text):
    ids = np.frombuffer(model.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_bos=True, add_eos=True)
    assert model.decode(ids) == library.decode(ids)


def test_pieces_of_edge_rows(edge, no_docs, library):
    got = pieces.decode(pieces.encode(edge, PIECES), PIECES, text_col="back")
    assert got.columns == [*edge.columns, "ids", "back"]
    for r in got.collect():
        want = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["back"] == library.decode(want)
    assert pieces.decode(pieces.encode(no_docs, PIECES), PIECES).count() == 0
    again = pieces.encode(edge.withColumn("ids", F.lit(1)), PIECES)
    assert again.columns.count("ids") == 1


def test_piece_query(spark, sf_dir, documents, library):
    import hashlib

    got = {tuple(r) for r in QUERIES["op6_piece_encoding"](spark, sf_dir).collect()}
    want = set()
    for i, t in documents:
        ids = library.encode(t, add_bos=True, add_eos=True)
        raw, back = np.array(ids, "<u4").tobytes(), library.decode(ids).encode()
        want.add((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert got == want


def test_one_worker_encodes_and_decodes(spark, sf_dir, edge):
    # Idle workers go to either step, so with two steps four workers of an executor of two cores hold an encoder.
    plan = QUERIES["op6_piece_encoding"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    two = pieces.decode(pieces.encode(edge, PIECES), PIECES).drop("text")
    one = pieces.encode(edge, PIECES, decoded_col="text")
    assert sorted(map(repr, one.select("doc_id", "ids", "text").collect())) == sorted(
        map(repr, two.select("doc_id", "ids", two["decoded"].alias("text")).collect())
    )


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 20)
    model, words = pieces.PieceModel(PIECES), [f"{a}{b}" for a in ("on", "Ther", "é,", ".\nSo") for b in range(60)]
    for k in range(0, 2 * len(words), 7):
        text = " ".join(words[i % len(words)] for i in range(k, k + 30))
        assert np.frombuffer(model.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        held = [model.words, model.older_words, model.atoms, model.older_atoms]
        assert max(map(len, held)) <= 20 and len(model.fits) <= 40
    # A word of one part is remembered once.
    assert not {pieces.SPACE + w for w in model.words} & {*model.atoms, *model.older_atoms}


@pytest.fixture(scope="module", params=FILES, ids=["bytes", "words"])
def words(request):
    return WordTokenizer(request.param)


@pytest.fixture(scope="module", params=FILES, ids=["bytes", "words"])
def forgetful(request):
    got = WordTokenizer(request.param)
    got.parts.size = got.pieces.size = 5
    return got


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(HARD, max_size=4))
def test_a_small_memory_changes_nothing(forgetful, texts):
    got = [forgetful.ids(x).tolist() for x in forgetful.encode_all(texts)]
    assert got == [forgetful.lib.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=3000, deadline=None)
@given(texts=st.lists(HARD, max_size=4))
def test_word_memory_as_the_library(words, texts):
    got = [words.ids(x).tolist() for x in words.encode_all(texts, words.end(2))]
    assert got == [[*words.lib.encode(t, add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("file", FILES)
def test_words_beside_marks_and_line_ends_share_calls(file):
    new = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    texts = [" ".join(f"x{w}.\n{w.upper()} y{w}***" for w in new), "a .\nb", "c .\n d", "e_\nf g.\n\nh i\nj é.\nÜ k.\n5", "x.\n'S"]
    words, calls = WordTokenizer(file), []

    class Counted:
        def encode_batch_fast(self, given, **settings):
            calls.extend(given)
            return Tokenizer.from_file(file).encode_batch_fast(given, **settings)

    words.lib = Counted()
    got = [words.ids(x).tolist() for x in words.encode_all(texts)]
    assert got == [Tokenizer.from_file(file).encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) < len(new) / 3


def test_memory_of_words_is_bounded():
    words = WordTokenizer(FILES[1])
    for first in (0, 1, 2, 3):
        words.encode_all([" ".join(f"x{i:x}" for i in range(first * 210_000, (first + 1) * 210_000))])
    assert len(words.parts.new) + len(words.parts.old) < 500_000


class Asked(dict):
    """Counts how often it is asked."""

    asked = 0

    def get(self, *args):
        Asked.asked += 1
        return super().get(*args)


@pytest.mark.parametrize("file", FILES)
def test_a_part_of_a_batch_is_looked_up_once(file):
    words, texts = WordTokenizer(file), ["a b c " * 50 + "d", "c  b a\n", " b", "", "b c " * 99 + "e"]
    words.parts.new = Asked()
    got = [words.ids(x).tolist() for x in words.encode_all(texts)]
    assert got == [words.lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert Asked.asked < 100
    assert id_type(file) == words.dtype
    Asked.asked = 0


@pytest.mark.parametrize("file", FILES)
def test_plain_words_go_straight_to_the_model(file):
    new = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    texts = ["a " + " ".join(f"{w} {w.title()}, {w.upper()}." for w in new), "b " + " ".join(new)]
    # A small letter joins an accent that the large one stands beside.
    texts += ["a J\u030c H\u0331. xT\u0308\nW\u030a J,\u030c J.\nJ\u030c", "a \xe9t\xe9 \xc9T\xc9. S\u0130X ba\u017f \u212a1 X_Y X\u0345"]
    words, calls = WordTokenizer(file), []

    class Counted:
        def encode_batch_fast(self, given, **settings):
            calls.extend(given)
            return Tokenizer.from_file(file).encode_batch_fast(given, **settings)

    words.lib = Counted()
    for _ in range(2):
        got = [words.ids(x).tolist() for x in words.encode_all(texts)]
        assert got == [Tokenizer.from_file(file).encode(t, add_special_tokens=False).ids for t in texts]
    assert not any(w in " ".join(calls[:-1]).lower() for w in new)


def ids_of(file, text):
    lib = Tokenizer.from_file(file)
    return np.array([*lib.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_records_of_edge_rows(spark, edge, no_docs):
    folder = new_path(spark, "records")
    manifest = records.write_records(edge, folder, FILES[0], 2, files=4)
    rows = sorted(((r["doc_id"], r["text"]) for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = sorted(map(tuple, records.read_records(spark, folder, manifest).collect()), key=lambda r: r[1])
    start = 0
    assert len(got) == len(rows)
    for (doc_id, at, ids), (want_id, text) in zip(got, rows, strict=True):
        want = ids_of(FILES[0], text)
        assert (doc_id, at) == (want_id, start) and ids == want.tobytes()
        start += len(want)
    listed = manifest.collect()
    assert 1 < len(listed) <= 4 and sum(r["docs"] for r in listed) == len(rows) and sum(r["tokens"] for r in listed) == start
    name = max(listed, key=lambda r: r["docs"])["name"]
    one, other = (list(records.shuffled(folder, name, seed)) for seed in (1, 2))
    key = lambda r: (repr(r.doc_id), r.ids.tobytes())
    assert sorted(map(key, one)) == sorted(map(key, other))
    empty = records.write_records(no_docs, new_path(spark, "records"), FILES[0], 2)
    assert records.read_records(spark, folder, empty).count() == 0


def test_damage_is_found():
    whole = records.frame(records.FRONT.pack(5, 1, 2) + b"\x01\x00\x02\x00")
    assert records.Record.parse(records.read_frame(io.BytesIO(whole))).ids.tolist() == [1, 2]
    assert records.read_frame(io.BytesIO(b"")) is None
    for i in range(len(whole)):
        broken = whole[:i] + bytes([whole[i] ^ 1]) + whole[i + 1 :]
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(broken))
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(whole[: i or 1]))


def test_record_query(spark, sf_dir, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_token_records"](spark, sf_dir).collect()}
    start = 0
    for i, t in sorted(documents):
        ids = ids_of(FILES[0], t)
        assert got.pop(i) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert not got


def check_packing(rows, want, limit):
    """rows: (doc_id, start, length, crc, doc_tokens, sequence_id, offset); want: ids by document."""
    by_doc, by_sequence = {}, {}
    for doc_id, start, length, crc, tokens, sequence, offset in rows:
        assert crc == zlib.crc32(want[doc_id][start : start + length]) and tokens == len(want[doc_id])
        by_doc.setdefault(doc_id, []).append((start, length))
        by_sequence.setdefault(sequence, []).append((offset, length))
    assert by_doc.keys() == want.keys()
    for spans, size in [(v, len(want[k])) for k, v in by_doc.items()] + [(v, None) for v in by_sequence.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == size if size else at <= limit
    return len(by_sequence)


def test_packing_query(spark, sf_dir, documents):
    want = {i: ids_of(FILES[1], t) for i, t in documents}
    rows = [tuple(r) for r in QUERIES["op8_packing"](spark, sf_dir).collect()]
    sequences = check_packing(rows, want, 4096)
    assert sequences * 4096 < 1.02 * sum(map(len, want.values())) + 2 * 4096


def test_packing_of_edge_rows(edge, no_docs):
    got = packing.pack_documents(edge, FILES[1], 2, 64).collect()
    pieces_of = {}
    for r in edge.collect():
        ids = ids_of(FILES[1], r["text"])
        for s in range(0, len(ids), 64):
            pieces_of.setdefault((r["doc_id"], len(ids)), 0)
        pieces_of[r["doc_id"], len(ids)] += len(ids)
    have = {}
    for r in got:
        have[r["doc_id"], r["doc_tokens"]] = have.get((r["doc_id"], r["doc_tokens"]), 0) + r["length"]
        assert len(r["ids"]) == 2 * r["length"]
    assert have == pieces_of
    assert packing.pack_documents(no_docs, FILES[1], 2, 64).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 300), max_size=20))
def test_plan_places_every_piece(histogram):
    plan = packing.plan(histogram, 32)
    used = {}
    for length, count in histogram.items():
        sequence, offset = plan.place(np.full(count, length), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            first = min(length, 32 - o)
            used.setdefault(s, []).append((o, first))
            if first < length:
                used.setdefault(s + 1, []).append((0, length - first))
    free = 0
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 32
        free += 32 - at
    assert free <= 32 + 2 * len(used)


def test_hot_length_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    cut = spark.createDataFrame([(i, 5 if i % 3 else 7) for i in range(300)], "piece long, length int")
    ranked = packing._ranked(cut, cut.groupBy("length").count()).collect()
    for length in (5, 7):
        ranks = sorted(r["rank"] for r in ranked if r["length"] == length)
        assert ranks == list(range(len(ranks)))
