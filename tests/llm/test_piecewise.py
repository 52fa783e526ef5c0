import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import prose

from millrace.llm import piecewise
from millrace.llm.queries import QUERIES


def plain_fingerprint(text):
    """The same fingerprint, byte by byte."""
    n = len(text)
    if not n:
        return "3::"
    padded, rolling = bytes(7) + text, []
    for i in range(n):
        window = padded[i + 1 : i + 8]
        total = sum(b * (k + 2) for k, b in enumerate(window))
        mixed = 0
        for b in window:
            mixed = (mixed << 5 ^ b) & 0xFFFFFFFF
        rolling.append((total + mixed) & 0xFFFFFFFF)

    def symbols(block, most):
        out, piece, place = [], 0, 0
        for i, b in enumerate(text):
            piece = (piece + (b + 1) * pow(piecewise.FACTOR, place, 1 << 64)) % (1 << 64)
            place += 1
            if i == n - 1 or (rolling[i] % block == block - 1 and len(out) < most - 1):
                mixed = (piece ^ piece >> 29) * int(piecewise.MIXER) % (1 << 64)
                out.append(chr(piecewise.SYMBOLS[mixed >> 58]))
                piece, place = 0, 0
        return "".join(out)

    block = 3
    while block * 64 < n:
        block *= 2
    while sum(r % block == block - 1 for r in rolling) < 31 and block > 3:
        block //= 2
    return f"{block}:{symbols(block, 64)}:{symbols(2 * block, 32)}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=5))
def test_same_as_byte_by_byte(texts):
    assert piecewise.fingerprint_texts(texts) == [plain_fingerprint(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", max_size=70), st.text("abcd", max_size=70))
def test_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    assert piecewise._common(a, b) == row[-1]


def test_likeness():
    a, b = prose(1, 400), prose(2, 400)
    edited = a[: len(a) * 2 // 3] + b[: len(a) // 3]
    fa, fb, fe = (piecewise.fingerprint_text(x.encode()) for x in (a, b, edited))
    assert piecewise.likeness_of(fa, fa) == 1.0
    assert piecewise.likeness_of(fa, fe) > 0.5 and piecewise.likeness_of(fa, fe) == piecewise.likeness_of(fe, fa)
    assert piecewise.likeness_of(fa, fb) < 0.2
    assert piecewise.likeness_of("3::", fa) == 0.0 and piecewise.likeness_of("3::", "3::") == 1.0
    assert piecewise.likeness_of("3:abc:de", "12:abc:de") == 0.0


def expected(rows):
    """Brute force over rows (id, text), in descending order of id, nulls last, then text."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (key, text) in enumerate(rows):
        after, third = rows[(i + 1) % len(rows)][1], len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        out.append((key, len(text), edited, *(piecewise.fingerprint_text(t.encode()) for t in (text, edited, after))))
    return out


def test_edge_rows(spark, edge, no_docs):
    want = expected([(r["doc_id"], r["text"] or "") for r in edge.collect()])
    assert sorted(map(tuple, piecewise.edited_by_next(edge).collect()), key=repr) == sorted(want, key=repr)
    assert piecewise.edited_by_next(no_docs).count() == 0
    one = edge.filter("doc_id = 6")
    assert [tuple(r)[:3] for r in piecewise.edited_by_next(one).collect()] == [(6, 4, "worw")]


def test_query_matches_brute_force(spark, sf_dir, documents):
    got = {tuple(r) for r in QUERIES["op2_fingerprints"](spark, sf_dir).collect()}
    like = piecewise.likeness_of
    want = {(i, n, hashlib.sha256(e.encode()).hexdigest(), f, fe, like(f, fe), like(f, fn)) for i, n, e, f, fe, fn in expected(documents)}
    assert got == want
    near = sorted(r[5] for r in got)
    assert near[len(near) // 10] > 0.5 and sorted(r[6] for r in got)[len(got) * 9 // 10] < 0.3
