"""State across micro-batches: records once, and their order per login.

Both keep keyed state in the query's checkpoint (RocksDB on the executors'
disks), so they go on after a restart where they stopped.

``once_per_record`` drops records that were sent or delivered again. The state
holds an identity for ``within`` after it arrived; a copy that comes later than
that counts as new. The clock is arrival, not the records' own time, so no first
record is ever too late.

``sequence_numbers`` numbers the records of each key in the order of (partition,
offset), over all batches. A batch holds the offsets of one key, two
numbers each, in one task; ``maxOffsetsPerTrigger`` (topics) or
``maxFilesPerTrigger`` (folders) bound the batch. Records of a partition must come in
offset order from batch to batch, as a topic delivers them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on disk, not in executor memory, for queries started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def record_identity(by: str = "offset"):
    """What makes two records the same: ``offset`` (topic, partition and offset;
    the content where a record has no offset) or ``value`` (topic, key and content,
    for producers that send a record again under a new offset)."""
    content = F.sha2(F.concat(F.coalesce(F.sha2("key", 256), F.lit("-")), F.coalesce(F.sha2("value", 256), F.lit("-"))), 256)
    if by == "value":
        return content
    if by != "offset":
        raise ValueError(f"identity is by offset or by value, not {by}")
    return F.when(F.col("offset").isNotNull(), F.concat_ws(":", F.coalesce("partition", F.lit(-1)), "offset")).otherwise(content)


def once_per_record(envelope: DataFrame, by: str = "offset", within: str = "1 day") -> DataFrame:
    """Records of an envelope stream, each once (see ``record_identity``). A batch
    DataFrame is deduplicated as a whole."""
    known = envelope.withColumn("__id", record_identity(by))
    if not envelope.isStreaming:
        return known.dropDuplicates(["topic", "__id"]).select(*envelope.columns)
    use_rocksdb(envelope.sparkSession)
    return (known.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", within)
            .dropDuplicatesWithinWatermark(["topic", "__id"]).select(*envelope.columns))


class SequenceNumbers(StatefulProcessor):
    """Counts the records of a key and numbers new ones in offset order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        parts = [(p["partition"].to_numpy("int64"), p["offset"].to_numpy("int64")) for p in rows]
        partition, offset = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((offset, partition))
        first = self.count.get()[0] if self.count.exists() else 0
        self.count.update((first + len(order),))
        for at in range(0, len(order), 10_000):
            now = order[at:at + 10_000]
            yield pd.DataFrame({"key": [key[0]] * len(now), "partition": partition[now], "offset": offset[now],
                                "seq": np.arange(first + at, first + at + len(now))})

    def close(self) -> None:
        """The handle closes its state."""


def sequence_numbers(records: DataFrame) -> DataFrame:
    """(key, partition, offset, seq) of a stream of records with ``key`` text: the
    0-based place of each among the records of its key. Unkeyed records are a
    group of their own, with a null key."""
    use_rocksdb(records.sparkSession)
    narrow = records.select(F.coalesce(F.concat(F.lit("="), F.col("key").cast("string")), F.lit("")).alias("k"),
                            F.coalesce("partition", F.lit(-1)).cast("long").alias("partition"),
                            F.col("offset").cast("long").alias("offset"))
    out = narrow.groupBy("k").transformWithStateInPandas(
        SequenceNumbers(), "key string, partition long, offset long, seq long", "Append", "None")
    return out.select(F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("key"), "partition", "offset", "seq")
