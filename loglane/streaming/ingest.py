"""Streaming ingest: landing files or topic records -> parsed tables.

Three feeds (trading lines, app-log lines, order messages), each from a
landing folder of finished files or from any stream in the topic-envelope
shape. A ``foreachBatch`` sink parses each micro-batch once, tags every row
with a reject reason or none, and writes the tagged rows once, partitioned by
outcome, to a staging folder. Its folders are then moved to:

* ``raw``: valid rows, partitioned by ``run_id`` and ``batch_id`` (and
  ``log_date`` for access rows);
* ``rejects``: rows that cannot be stored, with reason, preview, the whole
  line and, for topic records, their topic/partition/offset;
* optionally ``counters``: one row per batch (lines, sent, skipped,
  inserted, rejected).

Nothing is persisted on executors: a backlog of any size streams through one
scan and one write. A batch replayed after a failure replaces its own folders
(exactly-once effect). ``run_id`` is made once per ``raw`` path, so rows of two
raw paths whose batch ids both start at 0 can be told apart. The file sink is
not used: its metadata log would hide files added later by batch jobs such as
the day close.

Never start a new checkpoint over an existing ``raw`` path: batch ids would
restart at 0 and overwrite old batches. A new checkpoint needs a new path.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import ustrip
from ..operators import access_log as al
from ..operators import app_log as ap
from ..sources import fs
from ..sources.files import landing_files, landing_lines, landing_stream  # noqa: F401

MISSING_VALUE = "value is missing or not UTF-8"
UNDATED = "no date in the file name"
COUNTERS = "batch_id long, lines long, sent long, skipped long, inserted long, rejected long"
ACCESS_STORE = {"columns": al.ACCESS_LOG_COLUMNS, "source": "trading-access-logs", "loaded_at": "etl_timestamp", "dated": True}
REJECT_COLUMNS = ["source", "topic", "partition", "offset", "reason", "preview90", "raw"]


def run_id_of(spark: SparkSession, raw_path: str) -> str:
    """The identity of a raw path: made when it is first written to."""
    path = f"{raw_path.rstrip('/')}/_run_id"
    if not fs.exists(spark, path):
        fs.write_text(spark, path, "r" + uuid.uuid4().hex)
    return fs.read_text(spark, path)


def _move(spark: SparkSession, src: str, dst: str) -> None:
    """Replace folder ``dst`` by ``src`` (remove it where there is no ``src``)."""
    fs.delete(spark, dst)
    if fs.exists(spark, src):
        fs.mkdirs(spark, dst.rpartition("/")[0])
        if not fs.rename(spark, src, dst):
            raise OSError(f"could not publish {dst}")


def _days_of(spark: SparkSession, raw_path: str, batch: str, batch_id: int) -> set[str]:
    """Day folders that an earlier attempt of the batch may have written to. The
    last batch's days stand beside the data; only a batch older than that one
    (replayed by hand) is looked for in every day."""
    note = f"{raw_path}/_last_batch"
    if not fs.exists(spark, note):
        return set()
    last = json.loads(fs.read_text(spark, note))
    if last["batch_id"] == batch_id:
        return set(last["days"])
    if last["batch_id"] < batch_id:
        return set()
    return {c for c in fs.children(spark, raw_path)
            if c.startswith("log_date=") and fs.exists(spark, f"{raw_path}/{c}/{batch}")}


def store_batch(tagged: DataFrame, batch_id: int, raw_path: str, rejects_path: str, columns: list[str],
                source: str, loaded_at: str, dated: bool = False, count: bool = True) -> dict[str, int]:
    """Write a tagged batch (``columns``, reason, raw, topic, partition, offset)
    once and publish it; returns rows inserted and rejected (with ``count``).

    A batch touches the folders of its own days only, however many the table has."""
    spark = tagged.sparkSession
    raw_path, rejects_path = raw_path.rstrip("/"), rejects_path.rstrip("/")
    run = run_id_of(spark, raw_path)
    bad = F.col("reason").isNotNull()
    own = {"source": F.when(bad, F.lit(source)), "preview90": F.when(bad, F.substring("raw", 1, 90)),
           "raw": F.when(bad, F.col("raw"))}
    extra = [own.get(c, F.col(c)).alias(c) for c in REJECT_COLUMNS if c not in columns]
    out = tagged.select(*columns, *extra, F.current_timestamp().alias(loaded_at),
                        F.when(bad, F.lit("rejected")).otherwise(F.lit("valid")).alias("outcome"))
    staging = f"{raw_path}/_staging/{run}-{batch_id}"
    out.write.mode("overwrite").partitionBy("outcome", *(["log_date"] if dated else [])).parquet(staging)
    counts = dict.fromkeys(("valid", "rejected"), 0)
    if count and any(c.startswith("outcome=") for c in fs.children(spark, staging)):
        # row counts of file footers: no column is read
        rows = spark.read.schema("outcome string").parquet(staging).groupBy("outcome").count().collect()
        counts |= {r["outcome"]: r["count"] for r in rows}
    batch = f"run_id={run}/batch_id={batch_id}"
    if dated:
        new = fs.children(spark, f"{staging}/outcome=valid")
        days = {*new, *_days_of(spark, raw_path, batch, batch_id)}
        fs.write_text(spark, f"{raw_path}/_last_batch", json.dumps({"batch_id": batch_id, "days": sorted(days)}), overwrite=True)
        for day in days:
            _move(spark, f"{staging}/outcome=valid/{day}", f"{raw_path}/{day}/{batch}")
    else:
        _move(spark, f"{staging}/outcome=valid", f"{raw_path}/{batch}")
    _move(spark, f"{staging}/outcome=rejected", f"{rejects_path}/{batch}")
    fs.delete(spark, staging)
    return counts


def store_counted(lines: DataFrame, batch_id: int, tag: Callable[[DataFrame], DataFrame], counters_path: str | None,
                  sent: Column | None = None, **store) -> None:
    """``store_batch`` of ``tag(lines)``, and where ``counters_path`` is given one row
    of counters (lines, sent, skipped, inserted, rejected).

    Lines and sent lines are observed by the one scan that writes the batch. Of a
    batch that stores no row the plan may leave the observation out, so such a batch
    alone is counted by a scan of its own."""
    if not counters_path:
        store_batch(tag(lines), batch_id, count=False, **store)
        return
    spark = lines.sparkSession
    is_sent = F.coalesce(F.col("line").contains(F.lit(al.CID_MARKER)), F.lit(False)) if sent is None else sent
    seen = Observation(f"batch-{uuid.uuid4().hex}")
    counts = store_batch(tag(lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(is_sent).alias("sent"))),
                         batch_id, **store)
    if counts["valid"] or counts["rejected"]:
        got = seen.get
        row = (batch_id, got["lines"], got["sent"], got["lines"] - got["sent"], counts["valid"], counts["rejected"])
        out = spark.createDataFrame([row], COUNTERS)
    else:
        out = batch_counters(lines, batch_id, 0, 0, is_sent)
    (out.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(counters_path))


def batch_counters(lines: DataFrame, batch_id: int, inserted: int, rejected: int,
                   sent: Column | None = None) -> DataFrame:
    is_sent = F.coalesce(F.col("line").contains(F.lit(al.CID_MARKER)), F.lit(False)) if sent is None else sent
    n, s = F.count(F.lit(1)), F.count_if(is_sent)
    return lines.agg(n.alias("lines"), s.alias("sent"), (n - s).alias("skipped")).select(
        F.lit(batch_id).alias("batch_id"), "lines", "sent", "skipped",
        F.lit(inserted).cast("bigint").alias("inserted"), F.lit(rejected).cast("bigint").alias("rejected"))


def access_log_batch(lines: DataFrame, parser: Callable = al.parse_strict, log_date: str | None = None,
                     only_logins: bool = True) -> DataFrame:
    """Lines of one batch (line, file_name, raw, topic, partition, offset) ->
    access rows with a ``reason``, in one pass. A missing or undecodable value
    (NULL line) and a row without a day are rejects. With ``only_logins``, lines
    without ``cid:`` are skipped first, as the producer does; a consumer parses
    every record."""
    keep = ["raw", "topic", "partition", "offset"]
    if only_logins:
        lines = lines.where(F.col("line").isNull() | F.col("line").contains(F.lit(al.CID_MARKER)))
    parsed = parser(lines.withColumn("line", ustrip("line")).withColumn("__none", F.col("line").isNull()),
                    log_date=log_date, keep=[*keep, "__none"])
    return parsed.withColumn("reason", F.when(F.col("__none"), F.lit(MISSING_VALUE))
                             .when(F.col("log_date").isNull(), F.lit(UNDATED)).otherwise(al.length_violations()))


def _from_files(batch: DataFrame) -> DataFrame:
    """Landing lines with the columns that topic records have."""
    return batch.select("file_name", "line", F.col("line").alias("raw"), F.col("file_name").alias("topic"),
                        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"))


def access_log_sink(raw_path: str, rejects_path: str, parser: Callable = al.parse_strict,
                    log_date: str | None = None, counters_path: str | None = None
                    ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for trading lines. With ``counters_path``, one
    counters row per batch is written there as well."""
    def write(batch: DataFrame, batch_id: int) -> None:
        store_counted(_from_files(batch), batch_id, lambda x: access_log_batch(x, parser, log_date), counters_path,
                      raw_path=raw_path, rejects_path=rejects_path, **ACCESS_STORE)
    return write


def envelope_access_log_sink(raw_path: str, rejects_path: str, date_compact: str,
                             parser: Callable = al.parse_strict, counters_path: str | None = None
                             ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for topic records (the envelope schema). The
    day file and log_date come from the run's date (the consumer's
    ``LOG_DATE``); every record is parsed; rejects keep the record's topic,
    partition and offset."""
    from ..functions.dates import day_file_for, iso_from_compact
    from ..sources.files import envelope_lines

    file_name = day_file_for(date_compact)  # raises on a malformed date, before any batch runs
    log_date = iso_from_compact(date_compact)

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = envelope_lines(batch).withColumn("file_name", F.lit(file_name))
        store_counted(lines, batch_id, lambda x: access_log_batch(x, parser, log_date, only_logins=False), counters_path,
                      raw_path=raw_path, rejects_path=rejects_path, **ACCESS_STORE)
    return write


def ingest_topic_access_log(envelope_stream: DataFrame, raw_path: str, rejects_path: str, checkpoint: str,
                            date_compact: str, trigger: str = "availableNow",
                            counters_path: str | None = None, once_by: str | None = None,
                            once_within: str = "1 day") -> StreamingQuery:
    """Topic records (e.g. ``sources.kafka.read_topic_stream``) into ``raw``
    and ``rejects``. Progress lives in the checkpoint, not in a consumer
    group, so a restart resumes after the last committed micro-batch. With
    ``once_by`` (``offset`` or ``value``), records that come again within
    ``once_within`` are stored once (``state.once_per_record``)."""
    from .state import once_per_record

    guard_fresh_checkpoint(envelope_stream.sparkSession, checkpoint, raw_path, rejects_path)
    if once_by:
        envelope_stream = once_per_record(envelope_stream, once_by, once_within)
    return start(envelope_stream, envelope_access_log_sink(raw_path, rejects_path, date_compact,
                                                           counters_path=counters_path), checkpoint, trigger)


def _app_tagged(lines: DataFrame) -> DataFrame:
    """App-log lines (line, raw, topic, partition, offset) -> typed rows with a reason."""
    keep = ["__line", "topic", "partition", "offset", "__none"]
    src = lines.select(F.col("raw").alias("__line"), "topic", "partition", "offset",
                       F.col("line").isNull().alias("__none"), ustrip(F.coalesce("line", F.lit(""))).alias("line"))
    typed = ap.type_app_log(ap.parse_app_log(src, keep=keep))
    return typed.withColumn("reason", F.when(F.col("__none"), F.lit(MISSING_VALUE)).otherwise(F.col("reason"))) \
        .withColumn("raw", F.when(F.col("__none"), F.col("__line")).otherwise(F.col("raw")))


def _app_store(lines: DataFrame, batch_id: int, raw_path: str, rejects_path: str, counters_path: str | None) -> None:
    store_counted(lines, batch_id, _app_tagged, counters_path, sent=F.lit(True), raw_path=raw_path,
                  rejects_path=rejects_path, columns=ap.FIELDS, source="app-logs", loaded_at="created_at")


def envelope_app_log_sink(raw_path: str, rejects_path: str, counters_path: str | None = None
                          ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for app-log topic records."""
    from ..sources.files import envelope_lines

    def write(batch: DataFrame, batch_id: int) -> None:
        _app_store(envelope_lines(batch), batch_id, raw_path, rejects_path, counters_path)
    return write


def app_log_sink(raw_path: str, rejects_path: str, counters_path: str | None = None
                 ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for application-log lines."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _app_store(_from_files(batch), batch_id, raw_path, rejects_path, counters_path)
    return write


def order_sink(orders_path: str, rejects_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for order messages (JSON values)."""
    from ..operators.orders import decode_orders

    def write(batch: DataFrame, batch_id: int) -> None:
        msgs = batch.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), "value")
        dec = decode_orders(msgs, keep=["topic", "partition", "offset", "key", "value"])
        # Undecodable bytes are kept as hex in the reject row.
        dec = dec.withColumn("raw", F.coalesce("raw", F.hex("value")))
        store_batch(dec, batch_id, orders_path, rejects_path,
                    ["key", "order_id", "customer", "item", "quantity", "topic", "partition", "offset"],
                    "orders", "created_at", count=False)
    return write


def ingest_topic_app_log(envelope_stream: DataFrame, raw_path: str, rejects_path: str, checkpoint: str,
                         trigger: str = "availableNow", counters_path: str | None = None) -> StreamingQuery:
    """App-log topic records into ``raw`` and ``rejects``."""
    guard_fresh_checkpoint(envelope_stream.sparkSession, checkpoint, raw_path, rejects_path)
    return start(envelope_stream, envelope_app_log_sink(raw_path, rejects_path, counters_path), checkpoint, trigger)


def ingest_orders(envelope_stream: DataFrame, orders_path: str, rejects_path: str, checkpoint: str,
                  trigger: str = "availableNow") -> StreamingQuery:
    """Order topic records into ``orders`` and ``rejects`` (bad JSON is a
    reject row, not a crash)."""
    guard_fresh_checkpoint(envelope_stream.sparkSession, checkpoint, orders_path, rejects_path)
    return start(envelope_stream, order_sink(orders_path, rejects_path), checkpoint, trigger)


def guard_fresh_checkpoint(spark: SparkSession, checkpoint: str, *outputs: str) -> None:
    """Refuse a new checkpoint over outputs that already hold batches: batch
    ids would restart at 0 and the batch-id overwrites would replace the
    old batches. Use a new output path with a new checkpoint."""
    if fs.exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        return
    for out in outputs:
        if out and any(not c.startswith(("_", ".")) for c in fs.children(spark, out)):
            raise ValueError(f"{out} already holds batches but checkpoint {checkpoint} is new; "
                             "a new checkpoint needs a new output path")


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: str = "availableNow", name: str | None = None) -> StreamingQuery:
    """Start a foreachBatch query. ``trigger``: ``availableNow`` drains what
    is there and stops (bounded catch-up); ``"3 seconds"`` polls on a timer,
    the time half of a "500 rows or 3 s" flush rule."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()


def ingest_access_log(spark: SparkSession, landing_dir: str, raw_path: str, rejects_path: str,
                      checkpoint: str, trigger: str = "availableNow", max_files_per_trigger: int | None = None,
                      parser: Callable = al.parse_strict, counters_path: str | None = None,
                      newer_than_ms: int | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """Trading lines from a landing folder into ``raw`` and ``rejects``.
    ``newer_than_ms`` starts with files changed after that time; ``archive_dir``
    takes files that were read, so the folder's listing stays short."""
    guard_fresh_checkpoint(spark, checkpoint, raw_path, rejects_path)
    return start_landing(spark, landing_dir, access_log_sink(raw_path, rejects_path, parser, counters_path=counters_path),
                         checkpoint, trigger, max_files_per_trigger, newer_than_ms, archive_dir)


def ingest_app_log(spark: SparkSession, landing_dir: str, raw_path: str, rejects_path: str,
                   checkpoint: str, trigger: str = "availableNow", max_files_per_trigger: int | None = None,
                   counters_path: str | None = None, newer_than_ms: int | None = None,
                   archive_dir: str | None = None) -> StreamingQuery:
    """Application-log lines from a landing folder into ``raw`` and ``rejects``
    (options as for ``ingest_access_log``)."""
    guard_fresh_checkpoint(spark, checkpoint, raw_path, rejects_path)
    return start_landing(spark, landing_dir, app_log_sink(raw_path, rejects_path, counters_path),
                         checkpoint, trigger, max_files_per_trigger, newer_than_ms, archive_dir)


def start_landing(spark: SparkSession, landing_dir: str, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: str = "availableNow", max_files_per_trigger: int | None = None,
                  newer_than_ms: int | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """Start a query over the lines of a landing folder; each batch is read by as
    many tasks as its bytes need."""
    files = landing_files(spark, landing_dir, max_files_per_trigger, newer_than_ms, archive_dir)
    return start(files, lambda batch, batch_id: sink(landing_lines(batch), batch_id), checkpoint, trigger)


def progress_rates(query: StreamingQuery) -> list[dict]:
    """Per micro-batch that Spark still keeps (the latest 100 by default;
    ``streaming.monitor`` records all): input rows, lines/second in and processed, and the
    sources' lag metrics when they report any (the Kafka source reports
    ``avgOffsetsBehindLatest`` / ``maxOffsetsBehindLatest``)."""
    out = []
    for p in (query.recentProgress or []):
        lag = {}
        for src in p.get("sources", []) or []:
            for k, v in (src.get("metrics") or {}).items():
                if "OffsetsBehind" in k:
                    lag[k] = v
        out.append({"batchId": p["batchId"], "numInputRows": p["numInputRows"],
                    "inputRowsPerSecond": p.get("inputRowsPerSecond"),
                    "processedRowsPerSecond": p.get("processedRowsPerSecond"), "sourceLag": lag})
    return out
