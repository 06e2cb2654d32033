"""Small tables with the awkward rows that every operator must handle."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def prose(seed: int, n: int) -> str:
    """n words that depend on the seed; lines of twelve words with a full stop."""
    import random

    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghilmnoprstuv") for _ in range(r.randint(2, 9))) for _ in range(n)]
    lines = [" ".join(words[i:i + 12]).capitalize() + "." for i in range(0, n, 12)]
    return "\n".join(lines)


def documents() -> list[tuple]:
    """Nulls, empty and long texts, exact and near copies, ties, a shared
    passage, repeated rows and rows that share an id."""
    base, shared = prose(1, 120), prose(2, 30)
    near = base.replace(base.split()[50], "changed")
    half = " ".join(base.split()[:70] + prose(3, 50).split())
    rows = [
        (1, base), (2, base), (3, near), (4, half), (5, None), (6, ""), (7, "one two three"), (8, "one two three"),
        (9, "  \n\t "), (10, prose(4, 80) + "\n" + shared), (11, shared + "\n" + prose(5, 90)),
        (12, prose(6, 4000)), (13, prose(6, 4000)[:9000]), (14, "ä" * 300), (15, "ä" * 301), (16, "x" * 49),
        (17, "x" * 50), (18, "x" * 51), (19, "one two three four"), (20, "ONE two three four"),
        (21, prose(7, 60)), (21, prose(7, 60)), (22, prose(8, 60)), (22, prose(9, 60)), (None, base),
        (None, prose(10, 70)), (None, None), (23, "tail " + base), (24, "日本語 <|endoftext|> text  with   runs   end "),
    ]
    return [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]


def frame(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(documents() if rows is None else rows, schema)


def shingles(text: str | None) -> set:
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
