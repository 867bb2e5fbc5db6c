"""Small tables with awkward rows, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed: int, n: int) -> str:
    """Words of one fixed random draw."""
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


def changed(text: str, seed: int, n: int) -> str:
    """``text`` with n of its words replaced."""
    draw, parts = random.Random(seed), text.split(" ")
    for at in draw.sample(range(len(parts)), n):
        parts[at] = f"new{seed}x{at}"
    return " ".join(parts)


def documents() -> list[tuple]:
    """Copies, near copies, chains, short, empty, null and long texts, null ids, repeated rows."""
    base = sentence(1, 300)
    rows: list[tuple] = [(i, base, "en", "a", 1) for i in (3, 1, 2)]
    rows += [(10 + k, changed(base, k, 3 * k), "en", "a", 1) for k in range(1, 12)]
    rows += [(30 + k, sentence(100 + k, 20 + 7 * k), ("de", "fr")[k % 2], ("b", "c", None)[k % 3], None) for k in range(12)]
    rows += [(50, "one two three", "en", "b", 1), (51, "ONE two\tthree", None, "b", 1), (52, "one two", "en", None, 1)]
    rows += [(60, "", "en", "a", 0), (61, None, None, None, None), (62, " \n\t ", "en", "a", 3), (None, "no id at all here now", "en", "a", 1)]
    rows += [(70, sentence(7, 9000), "en", "a", 1), (71, changed(sentence(7, 9000), 5, 60), "en", "a", 1)]
    rows += [(80, sentence(8, 40), "en", "c", 1), (80, sentence(8, 40), "en", "c", 1)]
    rows += [(90, "x" * 5000, "en", "a", 1), (91, "élan über ñandú 漢字 " * 4, "es", "a", 1)]
    return rows


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
