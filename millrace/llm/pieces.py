"""Merge-type piece encoding by a prefix table, and decoding.

For every prefix of a text the encoding has one last piece, and it depends only on the last piece of a shorter prefix.
So one pass stores, for each prefix, its last piece: the automaton gives the pieces that end there, and the one that
may follow the last piece of the prefix before it is the answer. The ids are then read off backwards.

Two pieces may stand side by side if no merge would have joined a right edge of the first with a left edge of the
second before those edges went into their own pieces. Edges and the time at which each is taken up are worked out once
per piece from its own merges.

No piece of the model has a space mark after another character, so a text is cut before every run of space marks, and
further wherever no piece holds the two characters side by side. Each part is encoded by itself; parts that occur again
come from a bounded memory of the worker, which changes nothing in the result. Null text counts as empty. Empty text gives the begin and end ids alone. Characters without a piece
become byte pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fresh, memo, with_small_batches

SPACE = "▁"
#: Parts remembered in each of two generations, and pairs of pieces. When the newer is full it becomes the older one, and what
#: is still in use moves over. A worker holds all of it, and an executor has several.
MEMORY = 200_000
NEVER = float("inf")


class PieceModel:
    """Vocabulary of a merge-type model file; the file's own encoder is not used."""

    def __init__(self, model_file: str):
        lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        n = lib.get_piece_size()
        self.byte_ids = [0] * 256
        self.pieces: list[str] = [""] * n
        self.bytes: list[bytes] = [b""] * n
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for i in range(n):
            if lib.is_byte(i):
                value = int(lib.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                piece = lib.id_to_piece(i)
                self.pieces[i], self.ids[piece] = piece, i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                self.rank[piece] = -lib.get_score(i)
        self.finder = None

    def _prepare(self) -> None:
        """Tables that only encoding needs."""
        # Edges of a piece: (text, time it exists from, time it is taken up), outermost first.
        self.left: dict[str, list[tuple[str, float, float]]] = {}
        self.right: dict[str, list[tuple[str, float, float]]] = {}
        self.finder = ahocorasick.Automaton()
        made: dict[str, tuple[str, str, float]] = {}
        for piece in sorted(self.ids, key=len):
            if len(piece) == 1:
                self.left[piece] = self.right[piece] = [(piece, 0.0, NEVER)]
            elif parts := self._last_merge(piece):
                made[piece] = (*parts, max(self.rank[piece], *(made[p][2] if p in made else 0.0 for p in parts)))
                a, b, time = made[piece]
                born = [(piece, time, NEVER)]
                self.left[piece] = born + [(self.left[a][0][0], self.left[a][0][1], time)] + self.left[a][1:]
                self.right[piece] = born + [(self.right[b][0][0], self.right[b][0][1], time)] + self.right[b][1:]
            else:
                continue  # its own merges do not lead to it: never in an encoding
            self.finder.add_word(piece, (len(piece), self.ids[piece]))
        if len(self.finder):
            self.finder.make_automaton()
        # Characters side by side in some piece; no merge crosses any other place.
        self.inside = {piece[i : i + 2] for piece in self.left for i in range(len(piece) - 1)}
        self.fits: dict[int, bool] = {}
        # By text: what begins with a space mark goes without it into the words, all else into the atoms.
        self.words, self.older_words = {}, {}
        self.atoms, self.older_atoms = {}, {}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the merges inside ``piece`` join last, if they lead to it."""
        symbols, rank = list(piece), self.rank
        while len(symbols) > 2:
            best, at = NEVER, -1
            for i in range(len(symbols) - 1):
                r = rank.get(symbols[i] + symbols[i + 1], NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return (symbols[0], symbols[1]) if all(s in self.left for s in symbols) else None

    def compatible(self, first: int, second: int) -> bool:
        """Whether an encoding can hold piece ``second`` right after piece ``first``."""
        known = True
        for u, u_born, u_gone in self.right[self.pieces[first]]:
            for v, v_born, v_gone in self.left[self.pieces[second]]:
                r = self.rank.get(u + v)
                # Of two merges of the same rank the left one comes first.
                if r is not None and (time := max(r, u_born, v_born)) < u_gone and time <= v_gone:
                    known = False
                    break
            if not known:
                break
        if len(self.fits) >= 2 * MEMORY:
            self.fits.clear()
        self.fits[first << 32 | second] = known
        return known

    def encode_part(self, part: str) -> list[int]:
        """Ids of one part by the prefix table."""
        last = [0] * (len(part) + 1)  # id of the last piece of each prefix plus one; 0: a character in bytes
        fits, found = self.fits, 0
        if len(self.finder):
            for at, (size, piece) in self.finder.iter(part):
                at += 1
                if at == found:
                    continue
                if at > size and (before := last[at - size]):
                    known = fits.get((before - 1) << 32 | piece)
                    if known is None:
                        known = self.compatible(before - 1, piece)
                    if not known:
                        continue
                last[at] = piece + 1
                found = at
        ids: list[int] = []
        at, pieces = len(part), self.pieces
        while at:
            if piece := last[at]:
                ids.append(piece - 1)
                at -= len(pieces[piece - 1])
            else:
                ids.extend(self.byte_ids[x] for x in reversed(part[at - 1].encode("utf-8", "surrogatepass")))
                at -= 1
        ids.reverse()
        return ids

    def _part(self, part: str) -> bytes:
        inside, start, out = self.inside, 0, []
        for end in range(1, len(part) + 1):
            if end == len(part) or part[end - 1 : end + 1] not in inside:
                out.append(self._atom(part[start:end]))
                start = end
        return b"".join(out)

    def _atom(self, atom: str) -> bytes:
        if marked := atom[0] == SPACE:
            new, older, key = self.words, self.older_words, atom[1:]
        else:
            new, older, key = self.atoms, self.older_atoms, atom
        got = new.get(key)
        if got is None:
            got = older.get(key)
            if got is None:
                got = array("I", self.encode_part(atom)).tobytes()
            self._keep(key, got, marked)
        return got

    def _keep(self, key: str, ids: bytes, marked: bool) -> None:
        new, older = (self.words, self.older_words) if marked else (self.atoms, self.older_atoms)
        if len(new) >= MEMORY:
            older.clear()
            older.update(new)
            new.clear()
        new[key] = ids

    def _word(self, word: str) -> bytes:
        got = self.older_words.get(word)
        if got is None:
            got = self._part(SPACE + word)
        self._keep(word, got, True)
        return got

    def encode(self, text: str) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers."""
        first, last = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        if not text:
            return first + last
        if self.finder is None:
            self._prepare()
        words, known, new = text.replace(SPACE, " ").split(" "), self.words.get, self._word
        if "" not in words:
            return first + b"".join([known(w) or new(w) for w in words]) + last
        # Empty words are further spaces of a run; a run and the next word make one part.
        out, run = [first], ""
        for word in words:
            run += SPACE
            if word:
                out.append(known(word) or new(word) if len(run) == 1 else self._part(run + word))
                run = ""
        return b"".join([*out, self._part(run), last])

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids: pieces joined, space marks to spaces, without the space that encoding puts in front."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")

    def decode_bytes(self, ids: bytes) -> str:
        """Text of ids as ``encode`` gives them."""
        return self.decode(np.frombuffer(ids, "<u4").tolist())


def encode(docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with a column of ids, begin and end included, as little-endian unsigned 32-bit integers.

    ``decoded_col`` names a further column, the text decoded from those ids. The same worker makes both: a task of
    ``decode`` after ``encode`` needs two, and as Spark hands idle workers to either, each comes to hold an encoder's memory.
    Columns of these names are replaced. The text column must be a string; null counts as empty.
    """
    with_small_batches(docs.sparkSession)
    raw, made = fresh(docs, "raw"), [c for c in (ids_col, decoded_col) if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = memo(PieceModel, model_file)
        for batch in batches:
            at = batch.schema.get_field_index(raw)
            got = [model.encode((t or b"").decode("utf-8", "replace")) for t in batch.column(at).to_pylist()]
            out = _with(batch, at, ids_col, pa.array(got, pa.binary()))
            if decoded_col:
                out = out.append_column(decoded_col, pa.array(map(model.decode_bytes, got), pa.string()))
            yield out

    new = [T.StructField(ids_col, T.BinaryType()), *([T.StructField(decoded_col, T.StringType())] if decoded_col else [])]
    schema = T.StructType([*docs.drop(*made).schema.fields, *new])
    return docs.withColumn(raw, docs[text_col].cast("binary")).drop(*made).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for. A null in the ids counts as no ids."""
    with_small_batches(encoded.sparkSession)
    raw = fresh(encoded, "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = memo(PieceModel, model_file)
        for batch in batches:
            at = batch.schema.get_field_index(raw)
            got = [model.decode_bytes(t or b"") for t in batch.column(at).to_pylist()]
            yield _with(batch, at, text_col, pa.array(got, pa.string()))

    kept = encoded.drop(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType())])
    return kept.withColumn(raw, F.col(ids_col)).mapInArrow(run, schema)


def _with(batch: pa.RecordBatch, at: int, name: str, values: pa.Array) -> pa.RecordBatch:
    """``batch`` with column ``at`` replaced by ``values`` under another name."""
    columns = [values if i == at else c for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, [name if i == at else n for i, n in enumerate(batch.schema.names)])
