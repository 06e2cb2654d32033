"""Stream health as data: topics, partition offsets, group progress, lag.

Inputs are message envelopes (topic, partition, offset, ...) and a table of
committed offsets per (topic, partition); both are ordinary DataFrames, so
the reports run over a topic dump, a landing table or a source's progress.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def visible(envelope: DataFrame) -> DataFrame:
    """Skip internal topics (names starting with ``__``)."""
    return envelope.where(~F.col("topic").startswith("__"))


def topic_catalog(envelope: DataFrame) -> DataFrame:
    """Topics in name order with their partition counts."""
    return (visible(envelope).groupBy("topic")
            .agg(F.count_distinct("partition").alias("partitions"))
            .orderBy("topic"))


def partition_offsets(envelope: DataFrame) -> DataFrame:
    """Low and high watermark per partition; high is the next offset to be
    written."""
    return envelope.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))


# Status wording of the two lag reports.
STATUS_OK, STATUS_OK_APP = "OK", "OK - caught up"
STATUS_BEHIND, STATUS_BEHIND_APP_SUFFIX = "BEHIND by ", " messages"


def lag_status(lag, style: str = "trading"):
    """``OK`` / ``BEHIND by 12,345`` (trading style, thousands separators) or
    ``OK - caught up`` / ``BEHIND by 12345 messages`` (app style)."""
    if style == "app":
        return F.when(lag == 0, F.lit(STATUS_OK_APP)).otherwise(
            F.concat(F.lit(STATUS_BEHIND), lag.cast("string"), F.lit(STATUS_BEHIND_APP_SUFFIX)))
    return F.when(lag == 0, F.lit(STATUS_OK)).otherwise(
        F.concat(F.lit(STATUS_BEHIND), F.format_number(lag, 0)))


def consumer_lag(watermarks: DataFrame, committed: DataFrame, style: str = "trading") -> DataFrame:
    """Per partition: committed offset (negative or missing = none = 0), lag
    = high - committed, and a status label. Partitions of internal topics
    are left out."""
    j = visible(watermarks).join(committed.select("topic", "partition", "committed"),
                                 ["topic", "partition"], "left")
    c = F.greatest(F.coalesce(F.col("committed"), F.lit(0)), F.lit(0))
    lag = F.col("high") - c
    return j.select("topic", "partition", "low", "high", c.alias("committed"),
                    lag.alias("lag"), lag_status(lag, style).alias("status"))


def lag_for_topic(watermarks: DataFrame, committed: DataFrame, topic: str,
                  style: str = "trading") -> DataFrame:
    """Lag report of one topic; empty (not an error) when the topic does not
    exist yet."""
    return consumer_lag(watermarks.where(F.col("topic") == F.lit(topic)),
                        committed.where(F.col("topic") == F.lit(topic)), style)


def lag_totals(lag: DataFrame) -> DataFrame:
    """Detail, per-topic total and grand total of lag (rollup)."""
    return lag.rollup("topic", "partition").agg(F.sum("lag").alias("total_lag"))


def key_partition(key, partitions: int = 3):
    """Partition of a keyed message under CRC32 hashing of the key bytes
    (the C client's default for keyed messages). NULL key -> NULL (the
    client then picks a partition at random)."""
    return F.when(key.isNotNull(), F.pmod(F.crc32(key.cast("binary")), F.lit(partitions)).cast("int"))


def progress_offsets(spark: SparkSession, progress_json: list[str] | str) -> DataFrame:
    """Committed offsets from streaming progress (``query.lastProgress``
    JSON): the end offset per (topic, partition) of each Kafka source."""
    docs = [progress_json] if isinstance(progress_json, str) else list(progress_json)
    rows = []
    for doc in docs:
        prog = json.loads(doc) if isinstance(doc, str) else doc
        for src in prog.get("sources", []):
            end = src.get("endOffset")
            end = json.loads(end) if isinstance(end, str) else end
            if not isinstance(end, dict):
                continue
            for topic, parts in end.items():
                if isinstance(parts, dict):
                    rows += [(topic, int(p), int(o)) for p, o in parts.items()]
    return spark.createDataFrame(rows, "topic string, partition int, committed bigint")


def _read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _batch_ids(spark: SparkSession, folder: str) -> set[int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return set()
    return {int(st.getPath().getName()) for st in fs.listStatus(p) if st.getPath().getName().isdigit()}


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Committed offsets of a streaming query, read from its checkpoint: the
    source offsets of the last micro-batch that has a commit entry, one row
    per (topic, partition). This is the query's group progress; Spark does
    not commit offsets to the broker, so a broker-side group monitor would
    not see it. Sources without per-partition offsets (files) give no rows.
    Reads two small metadata files on the driver."""
    base = checkpoint.rstrip("/")
    done = _batch_ids(spark, f"{base}/offsets") & _batch_ids(spark, f"{base}/commits")
    rows = []
    if done:
        text = _read_text(spark, f"{base}/offsets/{max(done)}")
        for ln in text.splitlines()[2:]:  # version line, batch metadata, then one line per source
            try:
                doc = json.loads(ln)
            except ValueError:
                continue
            if isinstance(doc, dict):
                for topic, parts in doc.items():
                    if isinstance(parts, dict):
                        rows += [(topic, int(p), int(o)) for p, o in parts.items()]
    return spark.createDataFrame(rows, "topic string, partition int, committed bigint")
