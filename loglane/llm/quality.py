"""Line-first quality cleaning, with DataFrame functions only.

Every line of a text is judged by three rules and dropped where one fails:

* punctuation: more than ``MAX_LINE_SYMBOLS`` symbol characters per word, or
  no letter at all;
* navigation: at least two separators (``|``, ``»``, ``>``) that leave pieces
  of at most three words, or one to two words without a final mark;
* boilerplate: one of the fixed phrases below in a line of at most
  ``MAX_PHRASE_LINE`` words (a sentence that mentions one is no boilerplate).

A document whose kept lines hold less than ``MIN_KEPT_SHARE`` of its word
characters is rejected. Before that, the base measures of the contract are
taken over the whole text, and ``base_failed`` rejects too.

All work is per row: no shuffle, no Python. Windows of three words are
compared by 64-bit hash; they are sorted per text, so a text of n words costs
n log n. Defined results: null and empty texts have no words and fail the
base; a text without line breaks is one line; extra columns are kept by
``line_clean`` unless they carry one of its result names (then replaced).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LINE_SYMBOLS = 0.5
MIN_KEPT_SHARE = 0.6
#: Phrases of boilerplate lines, lower case.
BOILERPLATE = [
    "all rights reserved", "accept cookies", "cookie policy", "enable javascript",
    "log in to", "lorem ipsum", "privacy policy", "sign up for", "subscribe to our",
    "terms of service", "terms of use",
]
MAX_PHRASE_LINE = 10
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of other characters than space, tab, LF, VT, FF and CR."""
    return F.array_remove(F.split(text, SPACE), "")


def count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{re.escape(chars)}]+", ""))).cast("long")


def repeat_words(ws: Column) -> Column:
    """Words lying in a window of three words that occurs twice or more."""
    def covered(pos: Column) -> Column:  # sorted starts of repeated windows
        gaps = F.transform(pos, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), p - F.get(pos, i - 1))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(s: Column) -> Column:  # s: (hash, start), sorted
        same = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(same, lambda x: x["p"]))

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def counted(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        dup = let(pairs, lambda s: let(repeated(s), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), dup).otherwise(F.lit(0).cast("long"))

    return let(ws, lambda w: let(windows(w), counted))


def dup_lines(lines: Column) -> Column:
    worded = F.filter(lines, lambda x: x.rlike(WORD))
    return let(worded, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))


def line_ok(line: Column) -> Column:
    """Whether a line passes all three rules; lines without a word pass."""
    measures = F.struct(F.size(words(line)).alias("n"), count_of(line, SYMBOLS).alias("symbols"),
                        count_of(line, "|»>").alias("seps"), F.lower(line).alias("low"))

    def judged(m: Column) -> Column:
        n, seps = m["n"], m["seps"]
        punctuation = (m["symbols"] > n * F.lit(MAX_LINE_SYMBOLS)) | ~line.rlike(r"\p{L}")
        ended = line.rlike(r"[.!?:;,…\"'”»)][\x20\x09-\x0D]*$")
        navigation = ((seps >= 2) & (n - seps <= 3 * (seps + 1))) | ((n <= 2) & ~ended)
        boiler = F.lit(False)
        for phrase in BOILERPLATE:
            boiler = boiler | F.contains(m["low"], F.lit(phrase))
        return (n == 0) | ~(punctuation | navigation | (n <= MAX_PHRASE_LINE) & boiler)

    return let(measures, judged)


def line_clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures, ``clean_text`` (kept lines) and ``kept``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "clean_text", "kept"]
    src = docs.drop(*(c for c in docs.columns if c.lower() in names))
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(t, "\n")
    w = free_name(src.columns, "w")
    out = src.withColumns({
        "n_symbols": count_of(t, SYMBOLS),
        "n_dup_lines": dup_lines(lines),
        w: let(words(t), lambda x: F.struct(
            F.size(x).cast("long").alias("n"), F.length(F.array_join(x, "")).cast("long").alias("c"),
            repeat_words(x).alias("r"))),
        "clean_text": F.array_join(F.filter(lines, line_ok), "\n"),
    })
    out = out.withColumns({"n_words": F.col(w)["n"], "word_chars": F.col(w)["c"], "n_repeat_words": F.col(w)["r"]}).drop(w)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept_chars = F.length(F.regexp_replace("clean_text", SPACE, ""))
    return out.withColumns({"base_failed": failed,
                            "kept": ~failed & (kept_chars >= MIN_KEPT_SHARE * F.col("word_chars"))})


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_clean(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                   "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    ws = r"[^\x20\x09-\x0D]+"
    boiler = " or ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select rid, regexp_extract_all(t, '{ws}') as ws from d),
win as (
  select rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] as k
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, k) as c from win) where c > 1),
cov as (select rid, count(distinct p)::bigint as n from (
  select rid, unnest([i, i+1, i+2]) as p from rep) group by rid),
lines as (select rid, unnest(string_split(t, chr(10))) as l from d),
lw as (select rid, l, len(regexp_extract_all(l, '{ws}')) as n,
              len(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) as chars,
              len(l) - len(translate(l, '#*$%&|<>', '')) as sy,
              len(l) - len(translate(l, '|»>', '')) as seps from lines),
ln as (select rid, l, n, chars,
  n = 0 or not (
    sy > n * 0.5 or not regexp_matches(l, '\p{{L}}')
    or (seps >= 2 and n - seps <= 3 * (seps + 1))
    or (n <= 2 and not regexp_matches(l, '[.!?:;,…"''”»)][\x20\x09-\x0D]*$'))
    or (n <= 10 and ({boiler}))) as ok from lw),
lt as (select rid, coalesce(sum(case when ok then chars else 0 end), 0) as kept_chars,
  (count(*) filter (n > 0) - count(distinct l) filter (n > 0))::bigint as n_dup_lines from ln group by rid),
m as (
  select d.doc_id, len(w.ws)::bigint as n_words,
    len(regexp_replace(d.t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    (len(d.t) - len(translate(d.t, '#*$%&|<>', '')))::bigint as n_symbols,
    lt.n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words, lt.kept_chars
  from d join w using (rid) join lt using (rid) left join cov using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and kept_chars >= 0.6 * word_chars as kept
from m"""


SQL = {"op10_quality": _sql()}
