"""Cleaning of text keys and names."""

from __future__ import annotations

import unicodedata
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin() -> dict[str, str]:
    """Latin letters beyond ASCII and what is left of each without its marks, from the Unicode decompositions."""
    out = {}
    for c in map(chr, chain(range(0xC0, 0x250), range(0x1E00, 0x1F00))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain.isascii() and plain.isalpha():
            out[c] = plain
    return out


# Latin capitals that Unicode does not decompose.
UNMARKED = {"Æ": "AE", "Ð": "D", "Đ": "D", "Ħ": "H", "Ł": "L", "Ŋ": "NG", "Ø": "O", "Œ": "OE", "ẞ": "SS", "Þ": "TH", "Ŧ": "T"}
LETTERS = _latin() | UNMARKED
SINGLE = {c: p for c, p in LETTERS.items() if len(p) == 1}
DOUBLE = {c: p for c, p in LETTERS.items() if len(p) > 1}
# Fixed value: white space characters.
WHITE_SPACE = " \t\n\x0b\f\r"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_zeros(c: Column | str, min_zeros: int = 1) -> Column:
    """Remove leading zeros when there are at least ``min_zeros`` of them; a key of zeros alone keeps one.

    ``min_zeros=2`` leaves ``0ABC`` as it is and turns ``00ABC`` into ``ABC``.
    """
    key = _col(c).cast("string")
    short = F.ltrim(key, F.lit("0"))
    stripped = F.when((short == "") & (key != ""), "0").otherwise(short)
    return stripped if min_zeros <= 1 else F.when(key.startswith("0" * min_zeros), stripped).otherwise(key)


def pad_key(c: Column | str, n: int = 10) -> Column:
    """Left-pad a key with zeros to ``n`` characters; longer keys stay whole."""
    key = _col(c).cast("string")
    return F.when(F.length(key) >= n, key).otherwise(F.lpad(key, n, "0"))


def composite_key(*cs: Column | str, sep: str = "-") -> Column:
    """Join key parts with ``sep``; null as soon as one part is null."""
    parts: list[Column] = []
    for c in cs:
        if parts:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def has_text(c: Column | str) -> Column:
    """True when the text holds a visible character; null text gives null."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE)) != ""


def blank_to_null(c: Column | str) -> Column:
    """Text that is empty after trimming becomes null; other text is left as it is."""
    return F.when(F.trim(_col(c)) != "", _col(c))


def normalise_name(c: Column | str) -> Column:
    """Upper-case ASCII identifier made from a business name.

    In this order: upper case, ``/`` to ``_``, degree and ordinal signs to ``O``, dot to space, outer white space
    off, double spaces to one (one pass), space, ``=`` and ``-`` to ``_``, round brackets off, Latin letters to ASCII.
    """
    text = F.translate(F.upper(_col(c)), "/°º.", "_OO ")
    text = F.replace(F.btrim(text, F.lit(WHITE_SPACE)), F.lit("  "), F.lit(" "))
    text = F.translate(F.translate(text, " =-()", "___"), "".join(SINGLE), "".join(SINGLE.values()))
    return reduce(lambda t, d: F.replace(t, F.lit(d[0]), F.lit(d[1])), DOUBLE.items(), text)
