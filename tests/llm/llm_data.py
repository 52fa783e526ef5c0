"""Rows that no operator may trip over."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, place string, raw string, kept string, measures string, words string, task string"
WORDS = "the of and to in a is that it was for on with as by at from or an be this are".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) if rng.random() < 0.4 else "".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and blank texts, repeated rows, equal ids, hostile characters, a very long text."""
    a = prose(1, 80)
    texts = [
        (1, a),
        (1, a),  # the same row again
        (2, a),
        (2, a + " changed"),  # the same id again
        (None, a),
        (None, None),
        (3, None),
        (4, ""),
        (5, " \t\n\r "),
        (6, "word"),
        (7, "two words"),
        (8, "\x00 \x1f ‗▁▁ é é 😀 <|im_end|> <s> \\ \\n"),
        (9, "\n".join(["same line here"] * 30)),
        (10, prose(2, 60_000)),
        (11, "x" * 100_000),
        (-5, prose(3, 40)),
        (2**62, prose(4, 25)),
    ]
    return [(i, t, None if i is None else "en", "s", None if t is None else len(t), 7, "p", "r", "k", "m", "w", "t") for i, t in texts]
