"""Trading-server login lines -> access_log rows.

Line format: six tab fields, the last a free message whose parts are
separated by commas::

    CODE<TAB>4<TAB>3<TAB>HH:MM:SS.mmm<TAB>ip<TAB>'login': login (Client ... build N[, investor], cid: ..., point: ..., ping: ..., geo: ...)

``parse_strict`` is the positional parser: it splits on commas, splits the
first piece on tabs and reads fixed positions, padding a short list with
``Unknown``. Because ``, investor`` comes before ``cid:``, an investor row
gets ``cid = 'unknown'`` and ``server = 'cid: <hash>'``; this is kept.
``parse_labelled`` finds each field by its label instead.

Every function maps DataFrame -> DataFrame with native expressions only, so
the same code runs in batch and in a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_from_file_name
from ..functions.text import before_first, drop_chars, last, nth, split_keep, ustrip
from ..schemas import ACCESS_LOG_COLUMNS, ACCESS_LOG_LIMITS

# The marker of a login line and of an investor session.
CID_MARKER = "cid:"
INVESTOR_MARKER = "investor"
PENDING = "pending"


def cid_filter(df: DataFrame, line: str = "line") -> DataFrame:
    """Keep lines containing ``cid:`` (case-sensitive) and strip them (Python
    ``str.strip``). Stripping cannot change whether the marker occurs, so the
    raw line is tested: the test reaches the scan and dropped lines are never
    trimmed."""
    return df.where(F.col(line).contains(F.lit(CID_MARKER))).withColumn(line, ustrip(line))


def login_key(line: str | Column = "line") -> Column:
    """Message key: tab field 5, text before the first ``:``, stripped, quotes
    removed; NULL when the field is missing or the result is empty."""
    f5 = nth(split_keep(line, "\t"), 5)
    return F.nullif(drop_chars(ustrip(before_first(f5, ":")), "'"), F.lit(""))


def _with_log_date(df: DataFrame, file_name: str, log_date: str | Column | None) -> DataFrame:
    if log_date is None:
        return df.withColumn("log_date", date_from_file_name(file_name))
    if isinstance(log_date, str):
        return df.withColumn("log_date", F.to_date(F.lit(log_date)))
    return df.withColumn("log_date", log_date)


def parse_strict(df: DataFrame, line: str = "line", file_name: str = "file_name",
                 log_date: str | Column | None = None, keep: list[str] | None = None,
                 guard: Column | None = None) -> DataFrame:
    """Positional parse of (already filtered, stripped) login lines.

    ``log_date`` defaults to the date in the day-file name; pass an ISO date
    text or a Column to set it. ``keep`` lists extra input columns to carry
    (for example envelope coordinates). With ``guard``, lines where it is
    false are not split (their fields read as missing)."""
    keep = list(keep or [])
    df = _with_log_date(df, file_name, log_date)
    commas = split_keep(line, ",")
    # Positions 2.. of the reference's list; 0 and 1 are file name and date.
    fields = F.concat(split_keep(nth(commas, 0), "\t"),
                      F.slice(commas, F.lit(2), F.size(commas) - 1))
    if guard is not None:
        fields = F.when(guard, fields)
    bound = df.select(*keep, F.col(file_name).alias("file_name"), "log_date",
                      F.col(line).alias("__line"), fields.alias("__f"))

    def pos(i: int) -> Column:
        return F.coalesce(nth(F.col("__f"), i - 2), F.lit("Unknown"))

    f7, f8, f9 = pos(7), pos(8), pos(9)
    login = drop_chars(last(split_keep(ustrip(before_first(f7, ":")), " ")), "'")
    cid = F.coalesce(nth(split_keep(ustrip(f8), ": "), 1), F.lit("unknown"))
    inside = nth(split_keep(f7, "("), 1)
    device = F.coalesce(ustrip(before_first(inside, "build")), F.lit("unknown"))
    investor = F.when(F.col("__line").contains(F.lit(INVESTOR_MARKER)), "yes").otherwise("no")
    return bound.select(
        *keep, "file_name", "log_date", pos(5).alias("log_time"), pos(6).alias("ip"),
        login.alias("login"), cid.alias("cid"), device.alias("device"),
        ustrip(f9).alias("server"), F.lit(PENDING).alias("flag"), investor.alias("investor"))


# Label patterns of the documented line format.
LABEL_CID = r"\bcid: ([^,)]+)"
LABEL_POINT = r"\b(point: [^,)]+)"
LABEL_DEVICE = r": login \(([^,)]*?)(?: ?build [^,)]*)?[,)]"
LABEL_LOGIN = r"'([^']*)': login \("
LABEL_INVESTOR = r", investor, cid: "


def _extract(c: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL when there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def _extract_nonempty(c: Column, pattern: str) -> Column:
    """Same for a group that cannot match empty text: one regex pass."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def parse_labelled(df: DataFrame, line: str = "line", file_name: str = "file_name",
                   log_date: str | Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Parse by label: each field is found by its label, so the optional
    ``, investor`` part cannot shift ``cid`` into ``server``. Missing
    fields are NULL."""
    keep = list(keep or [])
    df = _with_log_date(df, file_name, log_date)
    tabs = split_keep(line, "\t")
    c = F.col(line)
    return df.select(
        *keep, F.col(file_name).alias("file_name"), "log_date",
        nth(tabs, 3).alias("log_time"), nth(tabs, 4).alias("ip"),
        _extract(c, LABEL_LOGIN).alias("login"),
        _extract_nonempty(c, LABEL_CID).alias("cid"),
        _extract(c, LABEL_DEVICE).alias("device"),
        _extract_nonempty(c, LABEL_POINT).alias("server"),
        F.lit(PENDING).alias("flag"),
        F.when(c.rlike(LABEL_INVESTOR), "yes").otherwise("no").alias("investor"))


def length_violations(limits: dict[str, int] = ACCESS_LOG_LIMITS) -> Column:
    """Reason text listing every column longer than its table limit, or NULL."""
    parts = [F.when(F.char_length(F.col(k)) > n, F.lit(f"{k} longer than {n}")) for k, n in limits.items()]
    return F.nullif(F.concat_ws("; ", *parts), F.lit(""))


def split_by_length(parsed: DataFrame, limits: dict[str, int] = ACCESS_LOG_LIMITS) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by the table's column limits. A long value rejects its
    row, never the whole batch. Both are plain filters, so later filters and
    column selections still reach the scan; a load that needs both writes the
    tagged rows once (``plans.batch_load``)."""
    tagged = parsed.withColumn("reason", length_violations(limits))
    return (tagged.where(F.col("reason").isNull()).select(*parsed.columns),
            tagged.where(F.col("reason").isNotNull()))

