"""Distinct logins per address as a state that adds up over days.

A day's state is one row per (ip, block of 32,768 login numbers) with a bitmap of
the logins seen, and one row per login that is no number. The state of a month is
the union of its days' rows: bitmaps are combined by OR, so nothing is scanned
again and a day that is computed twice counts once. Exact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What bitmap positions can number; other logins are kept as text.
MAX_NUMBER = 1 << 53


def day_state(trade_logins: DataFrame) -> DataFrame:
    """(log_date, ip, block, bits, login) of distinct or repeated (log_date, ip, login)
    rows: ``bits`` for numeric logins, ``login`` for others."""
    number = F.when(F.col("login").rlike("^(0|[1-9][0-9]{0,15})$"), F.col("login").try_cast("long"))
    n = trade_logins.withColumn("__n", F.when(number < MAX_NUMBER, number))
    block = F.bitmap_bucket_number(F.col("__n"))
    numeric = n.where("__n is not null").groupBy("log_date", "ip", block.alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("__n"))).alias("bits"))
    text = n.where("__n is null").select("log_date", "ip", F.lit(None).cast("long").alias("block"),
                                         F.lit(None).cast("binary").alias("bits"), "login").distinct()
    return numeric.withColumn("login", F.lit(None).cast("string")).unionByName(text)


def logins_by_month(state: DataFrame) -> DataFrame:
    """(month, ip, n_logins) from the states of any days: no line is read."""
    month = F.trunc("log_date", "month").alias("month")
    numeric = (state.where("bits is not null").groupBy(month, "ip", "block")
               .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
    text = (state.where("bits is null").groupBy(month, "ip", "login").agg(F.lit(1).cast("long").alias("n")))
    both = numeric.select("month", "ip", "n").unionByName(text.select("month", "ip", "n"))
    return both.groupBy("month", "ip").agg(F.sum("n").alias("n_logins"))
