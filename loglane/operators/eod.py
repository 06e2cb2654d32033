"""Day close: classify every access row of a day as ``trade`` or ``lilo``.

A row is ``trade`` when its IP placed trading activity in the same day file,
otherwise ``lilo`` (logged in, logged out). Matching is by (log_date, ip)
only; times are not compared, and every login seen on a trading IP is
flagged. Only rows still ``pending`` change, so flags set by an earlier run
stay as they are and a re-run changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_from_file_name
from ..functions.text import (before_first, contains_any, count_char, drop_chars, last,
                              split_keep, ustrip, ws_token)
from .access_log import PENDING

# Substrings that mark a trade line, and those that veto it
# (the veto wins). Matching is case-sensitive.
TRADE_INCLUDE = [
    "buy limit:", "order placed", "modify order", "order",
    "request transferred to dealers", "order modified",
    "modify", "position modified", "market sell",
    "order placed for execution", "market buy", "sell limit",
]
TRADE_EXCLUDE = [
    "request from", "confirm for", "received mail",
    "history deals synchronized", "history orders synchronized",
]
UNKNOWN = "unknown"
TRADE, LILO = "trade", "lilo"


def is_trade_line(line: str | Column = "line", include=TRADE_INCLUDE, exclude=TRADE_EXCLUDE) -> Column:
    return ~contains_any(line, exclude) & contains_any(line, include)


def trade_lines(day_lines: DataFrame, line: str = "line", include=TRADE_INCLUDE,
                exclude=TRADE_EXCLUDE) -> DataFrame:
    """Lines of a day file that carry trading activity."""
    return day_lines.where(is_trade_line(line, include, exclude))


def trade_tokens(df: DataFrame, line: str = "line", guard: Column | None = None) -> DataFrame:
    """(ip, login) of a trade line from whitespace tokens 4 and 5.

    ip is token 4 when it has exactly three dots (a shape test, not a
    numeric one), else ``unknown``; login is token 5 before ``:`` with
    quotes removed, ``unknown`` when missing. With ``guard``, lines where
    it is false are not tokenised at all (both come out ``unknown``)."""
    t4, t5 = ws_token(line, 4), ws_token(line, 5)
    if guard is not None:
        t4, t5 = F.when(guard, t4), F.when(guard, t5)
    bound = df.withColumn("__t4", t4).withColumn("__t5", t5)
    ip = F.when(count_char("__t4", ".") == 3, F.col("__t4"))
    login = drop_chars(last(split_keep(ustrip(before_first("__t5", ":")), " ")), "'")
    return bound.withColumn("ip", F.coalesce(ip, F.lit(UNKNOWN))).withColumn(
        "login", F.coalesce(login, F.lit(UNKNOWN))).drop("__t4", "__t5")


def _tokens_by_day(day_lines: DataFrame, line: str = "line", file_name: str = "file_name",
                   log_date: Column | None = None) -> DataFrame:
    d = log_date if log_date is not None else date_from_file_name(file_name)
    usable = (F.col("ip") != UNKNOWN) & (F.col("login") != UNKNOWN)
    tl = trade_tokens(trade_lines(day_lines, line), line)
    return tl.select(d.alias("log_date"), "ip", "login", usable.alias("__ok"))


def trade_ip_logins(day_lines: DataFrame, **kw) -> DataFrame:
    """The trade map as a relation: distinct (log_date, ip, login).

    Kept as rows rather than a per-IP set so a shared IP (NAT) never has
    to be gathered into one task; partial aggregation dedups map-side. The
    sentinel test is aggregated and filtered after the grouping: a filter on
    an aggregate result is not pushed into the tokenising projection, so each
    line is tokenised once (generated filters do not share subexpressions)."""
    return (_tokens_by_day(day_lines, **kw).groupBy("log_date", "ip", "login")
            .agg(F.max("__ok").alias("__ok")).where(F.col("__ok")).drop("__ok"))


def trade_ips(day_lines: DataFrame, **kw) -> DataFrame:
    """Distinct (log_date, ip) with trading activity: the join side. An IP
    counts when at least one of its trade lines has a usable login."""
    return (_tokens_by_day(day_lines, **kw).groupBy("log_date", "ip")
            .agg(F.max("__ok").alias("__ok")).where(F.col("__ok")).drop("__ok"))


def first_trade_times(day_lines: DataFrame, time: Column, line: str = "line",
                      file_name: str = "file_name") -> DataFrame:
    """(log_date, ip, first_time): when each trading IP first traded. A close
    that ran at any hour can be told from it: the IP was known if its first
    time is before that hour."""
    tl = trade_tokens(trade_lines(day_lines.withColumn("__time", time), line), line)
    usable = (F.col("ip") != UNKNOWN) & (F.col("login") != UNKNOWN)
    return (tl.select(date_from_file_name(file_name).alias("log_date"), "ip",
                      F.when(usable, F.col("__time")).alias("__time"))
            .groupBy("log_date", "ip").agg(F.min("__time").alias("first_time"))
            .where(F.col("first_time").isNotNull()))


def trade_ip_scan(day_lines: DataFrame, line: str = "line", file_name: str = "file_name",
                  log_date: Column | None = None) -> DataFrame:
    """One pass over a day file giving both the trade IPs and the line count:
    (log_date, ip, usable, lines) per key, where non-trade lines are not
    tokenised and fall in the ``unknown`` key. Trade IPs are the rows with
    ``usable``; lines scanned is the sum of ``lines``."""
    d = log_date if log_date is not None else date_from_file_name(file_name)
    t = trade_tokens(day_lines.withColumn("__t", is_trade_line(line)), line, guard=F.col("__t"))
    usable = (F.col("ip") != UNKNOWN) & (F.col("login") != UNKNOWN)
    return (t.select(d.alias("log_date"), "ip", usable.alias("usable"))
            .groupBy("log_date", "ip").agg(F.max("usable").alias("usable"), F.count(F.lit(1)).alias("lines")))


def flag_expr(hit: Column, in_scope: Column) -> Column:
    """Both updates in one expression: a pending row of a closed day becomes
    ``trade`` on a hit, else ``lilo``; every other row keeps its flag (NULL
    included)."""
    f = F.col("flag")
    return F.when(in_scope & (f == F.lit(PENDING)),
                  F.when(hit, F.lit(TRADE)).otherwise(F.lit(LILO))).otherwise(f)


def apply_flags(access: DataFrame, ips: DataFrame, log_dates: list[str] | None = None) -> DataFrame:
    """Flag ``access`` rows against the distinct trade IPs of their day.

    ``log_dates`` lists the days being closed (ISO text); None closes every
    day present. Rows without a ``log_date`` belong to no day and stay as they
    are. The IP side is distinct per (log_date, ip), so the left
    join never multiplies rows. Its size is known only at run time: AQE
    broadcasts it when the shuffled stage is under the broadcast threshold
    and otherwise keeps a sort-merge join, splitting skewed (NAT) IPs."""
    hits = ips.select("log_date", "ip", F.lit(True).alias("__hit"))
    if log_dates is not None:
        hits = hits.where(F.col("log_date").isin([F.to_date(F.lit(d)) for d in log_dates]))
    joined = access.join(hits, ["log_date", "ip"], "left")
    in_scope = F.col("log_date").isNotNull() if log_dates is None else F.col("log_date").isin(
        [F.to_date(F.lit(d)) for d in log_dates])
    out = joined.select(*[flag_expr(F.col("__hit").isNotNull(), in_scope).alias("flag") if c == "flag"
                          else F.col(c) for c in access.columns])
    return out


def flag_counts(flagged: DataFrame) -> DataFrame:
    """Per day: how many rows are trade, lilo and still pending."""
    f = F.col("flag")
    return flagged.groupBy("log_date").agg(
        F.count_if(f == TRADE).alias("trade_count"),
        F.count_if(f == LILO).alias("lilo_count"),
        F.count_if(f == PENDING).alias("pending_count"))


def scan_summary(day_lines: DataFrame, line: str = "line", file_name: str = "file_name") -> DataFrame:
    """Per day file: lines scanned and distinct trade IPs (exact)."""
    tl = trade_tokens(day_lines.withColumn("__t", is_trade_line(line)), line, guard=F.col("__t"))
    usable = (F.col("ip") != UNKNOWN) & (F.col("login") != UNKNOWN)
    return tl.groupBy(file_name).agg(
        F.count(F.lit(1)).alias("lines_scanned"),
        F.count_distinct(F.when(usable, F.col("ip"))).alias("trade_ips"))
