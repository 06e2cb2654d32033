"""Column helpers for messy text: Python-compatible strip/split, safe
positional access and substring tests. All are native expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

import sys
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.strip()``/``str.split()`` treat as whitespace,
# derived from ``str.isspace`` rather than listed. Spark's ``trim`` removes
# spaces only, and Java's ``\s`` misses U+001C..U+001F.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())



def _char_class(chars: str, negate: bool = False) -> str:
    """Regex class for a set of characters, written as code-point ranges."""
    cps = sorted(map(ord, chars))
    runs, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        runs.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        if cp is not None:
            start = prev = cp
    return "[" + ("^" if negate else "") + "".join(runs) + "]"


# Regex character classes with the same set (and its complement).
WS = _char_class(PY_WHITESPACE)
NON_WS = _char_class(PY_WHITESPACE, negate=True)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: str | Column) -> Column:
    """Python ``s.strip()``: remove leading and trailing whitespace."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def ws_token(c: str | Column, i: int) -> Column:
    """Python ``s.split()[i]`` or NULL when there are not that many tokens."""
    pattern = f"^{WS}*(?:{NON_WS}+{WS}+){{{i}}}({NON_WS}+)"
    # Tokens are never empty, so an empty extract means "no such token".
    return F.nullif(F.regexp_extract(col_of(c), pattern, 1), F.lit(""))


def split_keep(c: str | Column, sep: str) -> Column:
    """Python ``s.split(sep)`` for a literal separator (empty pieces kept)."""
    import re

    return F.split(col_of(c), re.escape(sep), -1)


def nth(arr: Column, i: int) -> Column:
    """0-based element, NULL when out of range (safe under ANSI mode)."""
    return F.get(arr, F.lit(i))


def last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def before_first(c: str | Column, sep: str) -> Column:
    """Python ``s.split(sep)[0]``."""
    return F.substring_index(col_of(c), sep, 1)


def drop_chars(c: str | Column, chars: str) -> Column:
    """Python ``s.replace(ch, '')`` for each single character in ``chars``."""
    return F.translate(col_of(c), chars, "")


def contains_any(c: str | Column, needles: Iterable[str]) -> Column:
    """True when any needle is a substring. Needles that contain another
    needle are redundant for an OR and are left out of the expression."""
    ns = list(dict.fromkeys(needles))
    kept = [n for n in ns if not any(o != n and o in n for o in ns)]
    if not kept:
        return F.lit(False)
    c = col_of(c)
    return reduce(lambda a, b: a | b, [c.contains(F.lit(n)) for n in kept])


def count_char(c: str | Column, ch: str) -> Column:
    """Python ``s.count(ch)`` for a single character."""
    c = col_of(c)
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def lossy_utf8(c: str | Column) -> Column:
    """Bytes or text decoded as UTF-8 with invalid sequences dropped
    (Python ``errors="ignore"``). A genuine U+FFFD is dropped as well."""
    return F.regexp_replace(F.make_valid_utf8(col_of(c).cast("string")), "\ufffd", "")
