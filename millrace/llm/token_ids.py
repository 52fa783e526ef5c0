"""Token ids of whole texts by a public tokenizer file, worked out once per distinct word of a worker.

The pre-tokenizers of these files never join characters across a single space between two others, and the space goes
with the word after it or is dropped. So a text is cut before every such space. A part that is new is cut further
where a letter or digit meets a mark of ASCII or a line end, and after a single line end: there, too, the pre-tokenizers
always cut. All of this is done once for each different part of a batch, in Arrow arrays. New pieces of a batch are encoded by
the library together; those of plain letters many to a text, with blanks or line ends between them, as the tokens themselves
tell where a word ends, and those of ASCII without the steps before the model, which leave them as they are. Parts and pieces that occur again come from
a bounded memory, which changes nothing in the result. A text that may hold the string of a special token, which the
library looks for first, or the one letter whose small form has a mark that joins what follows, is encoded whole.
"""

from __future__ import annotations

import gc
import os
import re
import string
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

#: Parts after a blank and pieces without one remembered in each of two generations. When the newer is full it takes the
#: older one's place, and what is still in use moves over, so that only seldom words are worked out again.
PARTS = 200_000
PIECES = 60_000
#: Texts of one call of the library, and words of one text.
CALL, JOINED = 4096, 4096
#: Letters that stay one letter each under the files' normalizers.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Marks of ASCII; a letter or digit before one ends a piece.
MARKS = string.punctuation
PART = re.compile(r"(?<=\S) (?=\S)")
PIECE = re.compile(r"(?<=[^\W_])(?=[!-/:-@\[-`{-~\n])|(?<=\S\n)(?=[^\W_])")
#: All white space.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
DOTTED = "İ"


class Memory:
    """Two generations of ids by text, rows (text, ids)."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, NOTHING, NOTHING

    def turn(self) -> None:
        """Between batches: start a new generation if the newer one is full."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, NOTHING

    def ids(self, texts: pa.Array, learn: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """Ids of different texts, by ``learn`` for those that are not known. All are in ``new`` afterwards."""
        held = [g for g in (self.new, self.old) if len(g)]
        known = pc.index_in(texts, pa.concat_arrays([g.column(0) for g in held])) if held else pa.nulls(len(texts), pa.int32())
        lost = known.is_null()
        at = known.fill_null(0).to_numpy().astype(np.int64)
        missing = texts.filter(lost)
        count = sum(map(len, held))
        at[lost.to_numpy(zero_copy_only=False)] = np.arange(count, count + len(missing))
        learned = pa.array(learn(missing.to_pylist()), pa.large_binary())
        ids = pa.concat_arrays([*(g.column(1) for g in held), learned]).take(pa.array(at))
        moved = pa.array(at >= len(self.new))
        added = pa.RecordBatch.from_arrays([texts.filter(moved), ids.filter(moved)], schema=NOTHING.schema)
        both = [self.new, added] if len(self.new) else [added]
        self.new = pa.RecordBatch.from_arrays([pa.concat_arrays([g.column(k) for g in both]) for k in range(2)], schema=NOTHING.schema)
        return ids


NOTHING = pa.RecordBatch.from_arrays([pa.array([], pa.large_string()), pa.array([], pa.large_binary())], ["text", "ids"])


def id_type(file: str) -> np.dtype:
    """Type of the ids of a tokenizer file, without keeping the tokenizer."""
    return np.dtype("<u2" if Tokenizer.from_file(file).get_vocab_size() <= 1 << 16 else "<u4")


class WordTokenizer:
    """Encodes texts to id bytes: ``width`` bytes an id, little-endian."""

    def __init__(self, file: str):
        self.lib = Tokenizer.from_file(file)
        self.lib.no_padding()
        self.lib.no_truncation()
        self.width = 2 if self.lib.get_vocab_size() <= 1 << 16 else 4
        self.dtype, self.code = np.dtype(f"<u{self.width}"), {2: "H", 4: "I"}[self.width]
        self.pieces, self.parts = Memory(PIECES), Memory(PARTS)
        # Special tokens are found whatever their case, as a file may lower-case before it looks for them.
        special = [re.escape(t.content) for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special), re.IGNORECASE) if special else None
        self.fronts = {t.content[:2] for t in self.lib.get_added_tokens_decoder().values()}

        # Whether letters of ASCII count as small. Only what no mark can follow is made small here: an accent may join a small letter alone.
        small, large = (self._call(list(x)) for x in (string.ascii_lowercase, string.ascii_uppercase))
        self.lowers = small == large
        # Letters of ASCII that go to the model as they are, after its mark of a blank: without the other steps of the library.
        self.bare = Tokenizer(self.lib.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ready = re.compile("[a-z]+" if self.lowers else "[A-Za-z]+")
        vocabulary = self.lib.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word, or else those that begin one
        self.ending = any(t.endswith("</w>") for t in vocabulary)
        self.ends[[i for t, i in vocabulary.items() if (t.endswith("</w>") if self.ending else t.startswith("Ġ"))]] = True
        self.line = vocabulary.get("Ċ", -1)  # a line end

    def _joined(self, words: list[str], blank: bool, ready: bool) -> list[bytes] | None:
        """Ids of words of letters, each after a blank or none, encoded as one text; None if they cannot be told apart."""
        if ready:
            lib, before = self.bare, " " if self.ending else " Ġ"
        else:
            lib, before = self.lib, " " if blank else "\n"
        ids = np.array(lib.encode_batch_fast([before + before.join(words)], add_special_tokens=False)[0].ids, self.dtype)
        at = np.flatnonzero(self.ends[ids] if self.ending or blank else ids == self.line)
        cuts = (self.width * np.concatenate([[0], at + 1] if self.ending else [at, [len(ids)]])).tolist()
        if len(cuts) != len(words) + 1 or cuts[0] != 0 or cuts[-1] != self.width * len(ids):
            return None
        raw, skip = ids.tobytes(), 0 if self.ending or blank else self.width
        return [raw[a + skip : b] for a, b in zip(cuts, cuts[1:])]

    def _new(self, pieces: list[str], blank: bool) -> list[bytes]:
        """Ids of different pieces, each after a blank or none."""
        got: dict[str, bytes] = {}
        groups: dict[bool | None, list[str]] = {True: [], False: [], None: []}  # ready, other letters, all else
        may = blank or self.ending
        for p in pieces:
            groups[True if may and self.ready.fullmatch(p) else False if LETTERS.fullmatch(p) else None].append(p)
        alone = groups.pop(None)
        for ready, words in groups.items():
            for i in range(0, len(words), JOINED):
                some = words[i : i + JOINED]
                ids = self._joined(some, blank, ready)
                if ids is None:
                    alone += some
                else:
                    got.update(zip(some, ids, strict=True))
        got.update(zip(alone, self._call([" " + p for p in alone] if blank else alone), strict=True))
        return list(map(got.__getitem__, pieces))

    def _whole(self, text: str) -> bool:
        """Whether a text must not be cut."""
        return DOTTED in text or any(f in text for f in self.fronts) and self.special.search(text) is not None

    def _call(self, texts: list[str]) -> list[bytes]:
        found = (e.ids for i in range(0, len(texts), CALL) for e in self.lib.encode_batch_fast(texts[i : i + CALL], add_special_tokens=False))
        return [array(self.code, ids).tobytes() for ids in found]

    def _parts(self, parts: pa.Array, heads: list[str], skipped: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Ids of parts, each after a blank, then of heads, which have none, and the places of the parts among them.

        Most parts are letters and digits, then perhaps marks, then perhaps one line end and letters and digits again.
        Those are cut at two places; the others, but for the skipped ones, wherever the pre-tokenizers cut.
        """
        n = len(parts)
        begins, data = _offsets(parts), parts.buffers()[2]
        line_end = pc.find_substring(parts, "\n").to_numpy().astype(np.int64)
        ended = line_end >= 0
        line = np.where(ended, line_end, np.diff(begins))
        lines = _cut(parts, begins[:-1], begins[:-1] + line).take(pa.array(np.arange(0, 2 * n, 2)))
        front = pc.binary_length(pc.ascii_rtrim(lines, characters=MARKS)).to_numpy()
        three = _cut(parts, begins[:-1], begins[:-1] + front, begins[:-1] + line + ended)
        fronts, tails, rests = (three.take(pa.array(np.arange(k, 3 * n, 3))) for k in range(3))
        if self.lowers:
            fronts, rests = pc.ascii_lower(fronts), pc.ascii_lower(rests)
        coded = [texts.dictionary_encode() for texts in (fronts, tails, rests)]
        codes = [c.indices.to_numpy() for c in coded]
        fits = _alnum(coded[0].dictionary)[codes[0]] & (_alnum(coded[2].dictionary)[codes[2]] | ~ended)
        used = [np.flatnonzero(np.bincount(c[fits], minlength=len(d.dictionary))) for c, d in zip(codes, coded, strict=True)]
        fronts, tails, rests = (d.dictionary.take(pa.array(u)) for d, u in zip(coded, used, strict=True))
        others = np.flatnonzero(~(fits | skipped))
        cut = [PIECE.split(" " + p) for p in parts.take(pa.array(others)).to_pylist()] + [PIECE.split(h) for h in heads]
        # Letters and digits after a blank are remembered as a part, without it.
        front_ids = self.parts.ids(fronts, lambda new: self._new(new, True))
        more = pa.array(dict.fromkeys(chain.from_iterable(cut)), pa.large_string())
        loose = pa.concat_arrays([tails, rests, more]).dictionary_encode()
        loose_ids = self.pieces.ids(loose.dictionary, lambda new: self._new(new, False))
        values = pa.concat_arrays([front_ids, loose_ids, pa.array([b""], pa.large_binary())])
        place = len(front_ids) + loose.indices.to_numpy().astype(np.int64)
        places = np.full(3 * n, len(values) - 1)
        for k, own in enumerate((np.arange(len(fronts)), place[: len(tails)], place[len(tails) : len(tails) + len(rests)])):
            of = np.zeros(len(coded[k].dictionary), np.int64)
            of[used[k]] = own
            places[k::3][fits] = of[codes[k][fits]]
        joined = values.take(pa.array(places))
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(_offsets(joined)[::3].copy()), joined.buffers()[2]])
        known = dict(zip(more.to_pylist(), loose_ids.take(loose.indices[len(tails) + len(rests) :]).to_pylist(), strict=True))
        rest = pa.array([b"".join(map(known.__getitem__, c)) for c in cut], pa.large_binary())
        at = np.arange(n)
        at[others] = n + np.arange(len(others))
        return pa.concat_arrays([ids, rest]), at

    def encode_all(self, texts: list[str], last: bytes = b"") -> list[bytes]:
        """Ids of each text, then ``last``."""
        collects = gc.isenabled()
        gc.disable()  # very many lists of strings, and no cycle among them
        try:
            return self._encode_all(texts, last)
        finally:
            if collects:
                gc.enable()

    def _encode_all(self, texts: list[str], last: bytes) -> list[bytes]:
        self.parts.turn()
        self.pieces.turn()
        whole = [i for i, t in enumerate(texts) if self._whole(t)]
        order = sorted(set(range(len(texts))).difference(whole))
        cut = pc.split_pattern(pa.array([texts[i] for i in order], pa.large_string()), " ")
        ends, parts = cut.offsets.to_numpy(), cut.flatten()
        later = np.ones(len(parts), bool)
        later[ends[:-1]] = False
        coded = parts.filter(pa.array(later)).dictionary_encode()  # every part but the first of a text
        heads = parts.take(pa.array(ends[:-1]))
        # A blank beside another white space is no place to cut.
        beside = _trimmed(coded.dictionary, pc.utf8_trim)
        shown = np.empty(len(parts), bool)
        shown[later], shown[ends[:-1]] = beside[coded.indices.to_numpy()], _trimmed(heads, pc.utf8_rtrim)
        careful = {k: PART.split(texts[order[k]]) for k in np.unique(np.searchsorted(ends, np.flatnonzero(shown), "right") - 1).tolist()}
        begun = heads.to_pylist()
        for k, c in careful.items():
            begun[k] = c[0]
        more = {p: k for k, p in enumerate(dict.fromkeys(p for c in careful.values() for p in c[1:]), len(beside))}
        skipped = np.concatenate([beside, np.zeros(len(more), bool)])
        ids, places = self._parts(pa.concat_arrays([coded.dictionary, pa.array(more, pa.large_string())]), begun, skipped)
        first = len(ids) - len(begun)
        at = np.empty(len(parts), np.int64)
        at[later], at[ends[:-1]] = places[coded.indices.to_numpy()], first + np.arange(len(begun))
        out = dict(zip(order, _by_text(ids.take(pa.array(at)), ends, last), strict=True))
        again = [np.array([first + k, *places[[more[p] for p in c[1:]]]], np.int64) for k, c in careful.items()]
        if again:
            whose = (order[k] for k in careful)
            out.update(zip(whose, _by_text(ids.take(pa.array(np.concatenate(again))), np.cumsum([0, *map(len, again)]), last), strict=True))
        out.update((i, ids + last) for i, ids in zip(whole, self._call([texts[i] for i in whole]), strict=True))
        return [out[i] for i in range(len(texts))]

    def encode(self, text: str, last: bytes = b"") -> bytes:
        return self.encode_all([text], last)[0]

    def end(self, token: int) -> bytes:
        return np.array([token], self.dtype).tobytes()

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.dtype)


def _offsets(values: pa.Array) -> np.ndarray:
    """Where each value of a large array begins in its data, and where the last one ends."""
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]


def _cut(texts: pa.Array, *begins: np.ndarray) -> pa.Array:
    """Every text cut at the given bytes of the data, the first of them its own begin: so many texts for each."""
    places = np.append(np.stack(begins, 1).ravel(), _offsets(texts)[-1:])
    return pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), texts.buffers()[2])


def _alnum(texts: pa.Array) -> np.ndarray:
    """``str.isalnum`` of each text."""
    out = pc.ascii_is_alnum(texts).to_numpy(zero_copy_only=False).copy()
    other = np.flatnonzero(~pc.string_is_ascii(texts).to_numpy(zero_copy_only=False))
    out[other] = list(map(str.isalnum, texts.take(pa.array(other)).to_pylist()))
    return out


def _trimmed(texts: pa.Array, trim: Callable) -> np.ndarray:
    """Whether a text is empty or ``trim`` finds white space at its end."""
    size = pc.binary_length(texts).to_numpy()
    return (size == 0) | (size != pc.binary_length(trim(texts, characters=BLANKS)).to_numpy())


def _by_text(ids: pa.Array, ends: np.ndarray, last: bytes) -> list[bytes]:
    """Ids of parts put together by text, then ``last``; ``ends``: where the parts of each text begin, and the end."""
    raw, cuts = memoryview(ids.buffers()[2] or b""), _offsets(ids)[ends].tolist()
    return [b"".join((raw[a:b], last)) for a, b in zip(cuts, cuts[1:], strict=False)]
