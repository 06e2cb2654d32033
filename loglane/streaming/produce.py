"""Producer side: lines from landing folders -> topic records.

The filter runs before anything is sent (only login lines go to the trading
topic), each record is keyed by login so one login's records share a
partition, and values are the stripped lines. Records are plain
(key, value) DataFrames; the command line writes them to a topic (where the
connector is installed) or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ustrip
from ..operators import access_log as al
from ..operators import offsets as off

TRADING_TOPIC = "trading-access-logs"
APP_TOPIC = "app-logs"


def trading_records(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Login lines -> (key, value[, partition]) records. ``partitions`` adds
    the CRC32 partition a C client would choose for the key."""
    kept = al.cid_filter(lines)
    key = al.login_key("line")
    cols = [key.alias("key"), F.col("line").alias("value")]
    if partitions:
        cols.append(off.key_partition(key, partitions).alias("partition"))
    return kept.select(*cols)


def app_records(lines: DataFrame) -> DataFrame:
    """Every app-log line, stripped, as an unkeyed record."""
    return lines.select(F.lit(None).cast("string").alias("key"), ustrip("line").alias("value"))
