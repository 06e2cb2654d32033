"""Topic edges (Spark's Kafka source and sink).

The core never depends on these: operators take the record envelope, which
these functions produce and consume. The Kafka connector jar is not part of
this installation, so only the option building is tested here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Flush on 500 rows or 3 seconds, whichever comes first.
FLUSH = {"min_offsets_per_trigger": 500, "max_trigger_delay": "3s"}


def source_options(bootstrap: str, topic: str, starting: str = "earliest", ending: str | None = None,
                   min_offsets_per_trigger: int | None = None, max_trigger_delay: str | None = None,
                   max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
                   extra: dict | None = None) -> dict:
    """Subscribe options. ``starting`` applies only when the query has no
    checkpoint yet; afterwards the checkpoint decides. ``min_offsets_per_trigger``
    with ``max_trigger_delay`` flushes on "500 rows or 3 seconds" (``FLUSH``).
    Records that aged out before they were read fail the query (Spark's
    default); pass ``failOnDataLoss`` in ``extra`` to skip them knowingly."""
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if ending:
        o["endingOffsets"] = ending
    if min_offsets_per_trigger:
        o["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    if max_trigger_delay:
        o["maxTriggerDelay"] = max_trigger_delay
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        o["minPartitions"] = str(min_partitions)
    o.update(extra or {})
    return o


def read_topic_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Streaming envelope DataFrame of a topic (from earliest and with ``FLUSH``
    by default)."""
    kw = {**FLUSH, **kw}
    return spark.readStream.format("kafka").options(**source_options(bootstrap, topic, **kw)).load()


def read_topic_batch(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """Bounded read of a whole topic: earliest to latest."""
    opts = source_options(bootstrap, topic, starting="earliest", ending="latest")
    return spark.read.format("kafka").options(**opts).load()


def sink_options(bootstrap: str, topic: str | None = None, linger_ms: int | None = None,
                 batch_size: int | None = None, extra: dict | None = None) -> dict:
    """Producer options; linger/batch size pass through to the client."""
    o = {"kafka.bootstrap.servers": bootstrap}
    if topic:
        o["topic"] = topic
    if linger_ms is not None:
        o["kafka.linger.ms"] = str(linger_ms)
    if batch_size is not None:
        o["kafka.batch.size"] = str(batch_size)
    o.update(extra or {})
    return o


def to_records(df: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Rows -> (key, value) text records for the sink; key NULL when absent."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), F.col(value).cast("string").alias("value"))


def write_topic(records: DataFrame, bootstrap: str, topic: str, **kw) -> None:
    records.write.format("kafka").options(**sink_options(bootstrap, topic, **kw)).save()


def write_topic_stream(records: DataFrame, bootstrap: str, topic: str, checkpoint: str, **kw):
    return (records.writeStream.format("kafka").options(**sink_options(bootstrap, topic, **kw))
            .option("checkpointLocation", checkpoint).start())
