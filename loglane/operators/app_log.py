"""Application-server log lines -> app_logs rows.

Line format::

    2031-07-05 08:00:00.250 | WARN  | user_id=u9 | endpoint=/v1/stock | ... [| error=...]

Parts are split on ``|`` and stripped; part 0 is the timestamp and part 1
the level; every later part holding ``=`` is a ``key=value`` pair split at
the first ``=``. Pairs are applied in order over the positional values, so a
later pair wins, including a ``timestamp=`` or ``level=`` pair. Unknown keys
are read and dropped. A line with fewer than two parts is rejected.

Implementation: one ``regexp_replace`` per line removes the white space
around pipes and before each pair's first ``=``. In that form the last pair of
a key starts at the last occurrence of the literal ``|key=``, so a field is
found by plain substring searches, without a pattern, a map or a lambda.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import where_computed
from ..functions.text import WS, before_first, ustrip
from ..schemas import APP_LOG_COLUMNS, APP_LOG_LIMITS

# Field names of the line format and the table.
FIELDS = ["timestamp", "level", "user_id", "endpoint", "method", "status", "duration_ms", "ip", "error"]
REASON_SHORT = "fewer than 2 fields"


def pair_section(line: Column) -> Column:
    """Parts 2.. of a line, each after a ``|``, without white space around pipes
    and before a part's first ``=``; empty with two parts or fewer."""
    rest = F.regexp_extract(line, r"(?s)^[^|]*\|[^|]*(\|.*)$", 1)
    return F.regexp_replace(rest, f"{WS}*\\|{WS}*([^|=]*?){WS}*(=|(?=\\|)|$)", "|$1$2")


def lookup(pairs: Column, key: str) -> Column:
    """Value of the last pair of ``key`` (stripped), NULL when there is none.
    ``pairs`` comes from ``pair_section``."""
    mark = f"|{key}="
    value = before_first(F.substring_index(pairs, mark, -1), "|")
    return F.when(pairs.contains(F.lit(mark)), ustrip(value))


def occurrences(pairs: Column, key: str) -> Column:
    mark = f"|{key}="
    gone = F.length(pairs) - F.length(F.replace(pairs, F.lit(mark), F.lit("")))
    return (gone / len(mark)).cast("int")


def parse_app_log(df: DataFrame, line: str = "line", keep: list[str] | None = None) -> DataFrame:
    """All lines with their fields as text (NULL when missing) and a
    ``reason`` that is NULL for parseable lines."""
    keep = list(keep or [])
    src = df.select(*keep, F.col(line).alias("raw"), pair_section(F.col(line)).alias("pairs"))
    c, pairs = F.col("raw"), F.col("pairs")
    p0 = ustrip(before_first(c, "|"))
    p1 = ustrip(F.substring_index(F.substring_index(c, "|", 2), "|", -1))
    cols = [F.coalesce(lookup(pairs, "timestamp"), p0).alias("timestamp"),
            F.coalesce(lookup(pairs, "level"), p1).alias("level")]
    cols += [lookup(pairs, k).alias(k) for k in FIELDS[2:]]
    reason = F.when(~c.contains(F.lit("|")), F.lit(REASON_SHORT))
    return src.select(*keep, "raw", *cols, reason.alias("reason"), "pairs")


def severity(status: Column) -> Column:
    """HTTP status -> level word: >=500 ERROR, >=400 WARN, else INFO."""
    return F.when(status >= 500, F.lit("ERROR")).when(status >= 400, F.lit("WARN")).otherwise(F.lit("INFO"))


def override_count(pairs: Column) -> Column:
    """How many times a stored field is set over an earlier value: a pair for
    ``timestamp``/``level`` overrides the positional value, and each repeat of
    any other field's key overrides the previous pair."""
    total = None
    for k in FIELDS:
        c = occurrences(pairs, k)
        term = c if k in ("timestamp", "level") else F.greatest(c - 1, F.lit(0))
        total = term if total is None else total + term
    return total


def _int_or_null(c: Column) -> Column:
    """Empty or missing -> NULL; otherwise an INT or NULL when not one."""
    return F.nullif(c, F.lit("")).try_cast("int")


def type_app_log(parsed: DataFrame, limits: dict[str, int] = APP_LOG_LIMITS) -> DataFrame:
    """Typed columns; rows that cannot be stored get a reject reason instead
    of failing the batch. ``timestamp`` is TIMESTAMP_NTZ (no zone)."""
    other = [c for c in parsed.columns if c not in FIELDS + ["reason", "pairs"]]
    typed = parsed.select(*other, F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
                          "level", "user_id", "endpoint", "method",
                          _int_or_null(F.col("status")).alias("status"),
                          _int_or_null(F.col("duration_ms")).alias("duration_ms"), "ip", "error",
                          F.col("reason").alias("__r0"), F.col("timestamp").alias("__ts"),
                          F.col("status").alias("__st"), F.col("duration_ms").alias("__du"))

    def bad_int(typed_col: str, text_col: str) -> Column:
        return F.col(typed_col).isNull() & (F.coalesce(F.col(text_col), F.lit("")) != F.lit(""))

    problems = [
        F.when(F.col("timestamp").isNull(), F.lit("timestamp is not a timestamp")),
        F.when(bad_int("status", "__st"), F.lit("status is not an integer")),
        F.when(bad_int("duration_ms", "__du"), F.lit("duration_ms is not an integer")),
    ] + [F.when(F.char_length(F.col(k)) > n, F.lit(f"{k} longer than {n}")) for k, n in limits.items()]
    reason = F.coalesce(F.col("__r0"), F.nullif(F.concat_ws("; ", *problems), F.lit("")))
    return typed.select(*other, *FIELDS, reason.alias("reason"))


def valid_rows(typed: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rows that can be stored."""
    return where_computed(typed, F.col("reason").isNull()).select(*(extra or []), *APP_LOG_COLUMNS)


def reject_rows(df: DataFrame, source: str, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Rows with a reason, in the reject-table shape (after the columns ``keep``)."""
    cols = set(df.columns)

    def opt(name: str, typ: str) -> Column:
        return (F.col(name) if name in cols else F.lit(None)).cast(typ).alias(name)

    shaped = df.select(
        *(keep or []), F.lit(source).alias("source"), opt("topic", "string"), opt("partition", "int"),
        opt("offset", "bigint"), "reason", F.substring(F.col(raw), 1, 90).alias("preview90"),
        F.col(raw).alias("raw"))
    return where_computed(shaped, F.col("reason").isNotNull())
