"""Group progress, lag and rates over time, as tables.

Spark keeps a query's progress in its checkpoint and tells no broker. A sink
wrapped by ``with_progress`` also writes, per batch, how far it got in each
partition, once the batch is stored. That is the committed offset of the group:
``committed`` for the present, ``lag_trend`` over time, whatever the source was."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import fs

PROGRESS = "topic string, partition int, committed long, records long, high long, at timestamp, batch_id long"


def with_progress(sink: Callable[[DataFrame, int], None], path: str,
                  watermarks: Callable[[], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function for envelope batches: ``sink``, then one row per
    (topic, partition) of the batch. ``watermarks`` gives (topic, partition, high)
    as of now, for the lag. A replayed batch replaces its rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        done = batch.where("offset is not null").groupBy("topic", "partition").agg(
            (F.max("offset") + 1).alias("committed"), F.count(F.lit(1)).alias("records"))
        high = watermarks().select("topic", "partition", "high") if watermarks else None
        done = done.withColumn("high", F.lit(None).cast("long")) if high is None else done.join(high, ["topic", "partition"], "left")
        (done.select("topic", F.col("partition").cast("int").alias("partition"), "committed", "records", "high",
                     F.current_timestamp().alias("at"))
         .coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))
    return write


def progress(spark: SparkSession, path: str) -> DataFrame:
    """All recorded rows; none where nothing was recorded yet."""
    if not any(c.startswith("batch_id=") for c in fs.children(spark, path)):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).parquet(path)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, committed): the next offset that the group reads."""
    return progress(spark, path).groupBy("topic", "partition").agg(F.max("committed").alias("committed"))


def lag_trend(recorded: DataFrame) -> DataFrame:
    """Per batch and partition: lag, its change since the partition's batch before,
    and how many batches the lag would last at this batch's pace (null at a pace of
    0). The window groups hold a row per batch of one partition."""
    by = Window.partitionBy("topic", "partition").orderBy("batch_id")
    lag = F.greatest(F.col("high") - F.col("committed"), F.lit(0))
    out = recorded.withColumn("lag", lag)
    return out.select("batch_id", "topic", "partition", "committed", "high", "records", "lag",
                      (F.col("lag") - F.lag("lag").over(by)).alias("lag_change"),
                      F.try_divide(F.col("lag"), F.col("records")).alias("batches_left"))


def rate_by_window(records: DataFrame, time: str | Column = "timestamp", every: str = "1 minute",
                   late: str = "10 minutes", by: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Records per time window and per second, batch or streaming. A stream keeps
    a window open until ``late`` after its end; rows later than that are not counted."""
    t = records.withColumn("__t", F.col(time) if isinstance(time, str) else time)
    if records.isStreaming:
        t = t.withWatermark("__t", late)
    w = F.window("__t", every)
    counted = t.where(F.col("__t").isNotNull()).groupBy(*by, w.alias("w")).agg(F.count(F.lit(1)).alias("records"))
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    return counted.select(*by, F.col("w.start").cast("timestamp_ntz").alias("window_start"), "records",
                          F.round(F.col("records") / seconds, 6).alias("per_second"))
