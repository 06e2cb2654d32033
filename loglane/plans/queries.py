"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the warehouse tables. Raw lines and messages are rendered from
them once (``sources.fixtures`` via ``sources.derived``) and then run
through the library's operators, as lines from a log server or records
from a topic would be."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_from_file_name
from ..functions.rows import where_computed
from ..functions.sequence import dense_rank_in_groups
from ..functions.text import ustrip
from ..operators import access_log as al
from ..operators import app_log as ap
from ..operators import eod
from ..operators import offsets as off
from ..operators import orders as od
from ..sources import fixtures
from ..sources.derived import derived_path, derived_table
from ..session import work_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")


# --- stored inputs -----------------------------------------------------------

def day_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trading day files: (file_name, line_no, line)."""
    return derived_table(spark, "trading_lines", [_path(sf_dir, "events")],
                         lambda: fixtures.trading_lines(events(spark, sf_dir)))


def app_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application log: (line_no, line)."""
    return derived_table(spark, "app_lines", [_path(sf_dir, "events")],
                         lambda: fixtures.app_log_lines(events(spark, sf_dir)))


def access_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded access_log table (rows that fit), partitioned by log_date:
    what the streaming ingest leaves for the day close."""
    def build():
        parsed = al.parse_strict(al.cid_filter(day_lines(spark, sf_dir)))
        valid, _ = al.split_by_length(parsed)
        # Files cover (log_date, ip) ranges; never one task per day.
        # The time splits a hot address.
        return (valid.repartitionByRange("log_date", "ip", "log_time").sortWithinPartitions("log_date", "ip"))
    return derived_table(spark, "access_log", [_path(sf_dir, "events")], build,
                         partition_by=["log_date"]).select(*al.ACCESS_LOG_COLUMNS)


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records as topic messages with broker-style offsets."""
    return derived_table(spark, "event_envelope", [_path(sf_dir, "events")],
                         lambda: fixtures.event_envelope(events(spark, sf_dir)))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages as they sit on the topic: (key, value) bytes."""
    def build():
        enc = od.encode_orders(fixtures.order_rows(table(spark, sf_dir, "orders")))
        return enc.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return derived_table(spark, "order_messages", [_path(sf_dir, "orders")], build)


def parsed_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.parse_strict(al.cid_filter(day_lines(spark, sf_dir)))


# --- day close ---------------------------------------------------------------

@query("eod_flags")
def eod_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: close every day: each loaded access row becomes trade or
    lilo by the trade IPs of its own day file."""
    return eod.apply_flags(access_table(spark, sf_dir), eod.trade_ips(day_lines(spark, sf_dir)))


@query("eod_flag_counts")
def eod_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-close summary per day: rows set to trade and to lilo."""
    return eod.flag_counts(eod_flags(spark, sf_dir))


CUTOFF = "18:00:00.000"


@query("eod_rerun_sticky")
def eod_rerun_sticky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two closes of each day: the first at 18:00 over the rows and the day
    file as they were then, the second after the rest arrived. Flags set by
    the first run stay; only rows still pending are classified again. One
    aggregate and one join serve both runs: an address counted in the first run
    if it had traded by then (``close_day_two_feeds`` closes stored tables)."""
    line_time = F.get(F.split(F.col("line"), "\t"), F.lit(3))
    first = eod.first_trade_times(day_lines(spark, sf_dir), line_time)
    early = F.coalesce(F.col("log_time") < CUTOFF, F.lit(False))
    hit = F.coalesce(F.when(early, F.col("first_time") < CUTOFF).otherwise(F.col("first_time").isNotNull()), F.lit(False))
    rows = access_table(spark, sf_dir).join(first, ["log_date", "ip"], "left")
    return rows.withColumn("flag", eod.flag_expr(hit, F.col("log_date").isNotNull())).select(*al.ACCESS_LOG_COLUMNS)


@query("trade_line_filter")
def trade_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full scan of every day file, keeping lines with trading activity."""
    return eod.trade_lines(day_lines(spark, sf_dir)).select("file_name", "line_no")


@query("trade_ip_logins")
def trade_ip_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade map: distinct (log_date, ip, login)."""
    return eod.trade_ip_logins(day_lines(spark, sf_dir))


@query("trade_ip_login_counts")
def trade_ip_login_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each IP's login set per day (two-level aggregate, no set
    gathered in one task)."""
    return (eod.trade_ip_logins(day_lines(spark, sf_dir))
            .groupBy("log_date", "ip").agg(F.count(F.lit(1)).alias("n_logins")))


@query("trade_ip_logins_by_month")
def trade_ip_logins_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct logins per address and month, from bitmap states kept per day."""
    from ..operators.distinct_state import day_state, logins_by_month

    state = derived_table(spark, "trade_login_state", [_path(sf_dir, "events")],
                          lambda: day_state(eod.trade_ip_logins(day_lines(spark, sf_dir))), partition_by=["log_date"])
    return logins_by_month(state)


@query("trade_scan_summary")
def trade_scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day file: lines scanned and distinct trade IPs."""
    return eod.scan_summary(day_lines(spark, sf_dir))


# --- trading-line ingest -------------------------------------------------------

@query("cid_filter")
def cid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login lines kept by the producer-side filter, and how much stray
    whitespace the strip removed."""
    raw = day_lines(spark, sf_dir).withColumnRenamed("line", "raw")
    kept = al.cid_filter(raw.withColumn("line", F.col("raw")))
    return kept.select("file_name", "line_no",
                       (F.char_length("raw") - F.char_length("line")).alias("stripped_chars"))


@query("access_log_parse_strict")
def access_log_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional parse of every login line (investor shift kept)."""
    return parsed_access(spark, sf_dir)


@query("access_log_parse_labelled")
def access_log_parse_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse of every login line by field labels."""
    return al.parse_labelled(al.cid_filter(day_lines(spark, sf_dir)))


@query("access_log_length_rejects")
def access_log_length_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed rows too long for the table, each with its reason."""
    _, rejected = al.split_by_length(parsed_access(spark, sf_dir))
    return rejected.select("file_name", "log_time", "ip", "login", "reason")


@query("login_key")
def login_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message keys of the login lines, with message counts per key."""
    kept = al.cid_filter(day_lines(spark, sf_dir))
    return kept.groupBy("file_name", al.login_key("line").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"))


def trading_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = al.cid_filter(day_lines(spark, sf_dir))
    key = al.login_key("line")
    return kept.select("file_name", "line_no", key.alias("key"),
                       off.key_partition(key).alias("partition"), "line")


@query("key_partition")
def key_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition of every keyed login message (3 partitions, CRC32), with
    message counts: the same key always lands in the same partition."""
    return trading_topic(spark, sf_dir).groupBy("key", "partition").agg(
        F.count(F.lit(1)).alias("messages"))


@query("login_event_order")
def login_event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per login, the position of each of its messages in arrival order
    (what one partition preserves for one key)."""
    t = trading_topic(spark, sf_dir)
    ranked = dense_rank_in_groups(t, ["key"], "line_no", "seq")
    return ranked.select("key", "line_no", "seq")


@query("log_date_from_file")
def log_date_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log_date of every line from its day-file name, counted per file."""
    return (day_lines(spark, sf_dir)
            .groupBy("file_name").agg(F.count(F.lit(1)).alias("lines"))
            .select("file_name", date_from_file_name("file_name").alias("log_date"), "lines"))


@query("ingest_counters")
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day file: lines read, sent (login lines), skipped, inserted and
    rejected rows, in one scan and one aggregate (only sent lines are split)."""
    lines = day_lines(spark, sf_dir).withColumn("line", ustrip("line"))
    sent = F.col("line").contains(F.lit(al.CID_MARKER))
    tagged = al.parse_strict(lines.withColumn("__sent", sent), keep=["__sent"], guard=F.col("__sent"))
    tagged = tagged.withColumn("__bad", al.length_violations().isNotNull())
    s, bad = F.col("__sent"), F.col("__bad")
    return tagged.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(s).alias("sent"), F.count_if(~s).alias("skipped"),
        F.count_if(s & ~bad).alias("inserted"), F.count_if(s & bad).alias("rejected"))


# --- application log -----------------------------------------------------------

def _app_parsed(spark, sf_dir):
    lines = app_lines(spark, sf_dir).withColumn("line", ustrip("line"))
    return ap.parse_app_log(lines, keep=["line_no"])


@query("app_log_parse")
def app_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parseable app-log lines with their fields as text."""
    p = _app_parsed(spark, sf_dir)
    return p.where(F.col("reason").isNull()).select("line_no", *ap.FIELDS)


@query("app_log_typed")
def app_log_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows ready for the app_logs table (typed, within limits)."""
    return ap.valid_rows(ap.type_app_log(_app_parsed(spark, sf_dir)), extra=["line_no"])


@query("kv_last_wins")
def kv_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines where a field is set more than once (a repeated pair, or a
    pair over a positional value) and the value that won."""
    p = _app_parsed(spark, sf_dir).withColumn("overrides", ap.override_count(F.col("pairs")))
    won = where_computed(p, F.col("reason").isNull() & (F.col("overrides") > 0))
    return won.select("line_no", "timestamp", "level", "status", "overrides")


@query("app_log_rejects")
def app_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every app-log line that cannot be stored: its number, the reason, the
    whole line and the 90-character preview."""
    t = ap.type_app_log(_app_parsed(spark, sf_dir))
    return ap.reject_rows(t, "app-logs", keep=["line_no"]).select("line_no", "reason", "preview90", "raw")


@query("status_severity")
def status_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity word by status (>=500 ERROR, >=400 WARN, else INFO), padded
    to 5, and how often each status occurs among stored rows."""
    t = app_log_typed(spark, sf_dir).where(F.col("status").isNotNull())
    return t.groupBy("status").agg(F.count(F.lit(1)).alias("lines")).select(
        "status", F.rpad(ap.severity(F.col("status")), 5, " ").alias("severity"), "lines")


# --- orders ----------------------------------------------------------------------

@query("orders_json_encode")
def orders_json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows -> keyed JSON messages."""
    return od.encode_orders(fixtures.order_rows(table(spark, sf_dir, "orders")))


@query("orders_json_decode")
def orders_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages off the topic -> order columns."""
    msgs = order_messages(spark, sf_dir)
    dec = od.decode_orders(msgs.withColumn("key", F.col("key").cast("string")), keep=["key"])
    return where_computed(dec, F.col("reason").isNull()).select("key", "order_id", "customer", "item", "quantity")


@query("orders_json_rejects")
def orders_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged order messages, each with its reason."""
    bad = fixtures.order_texts(table(spark, sf_dir, "orders"))
    dec = od.decode_orders(bad, keep=["o_orderkey"])
    return where_computed(dec, F.col("reason").isNotNull()).select("o_orderkey", "reason")


# --- stream health -----------------------------------------------------------------

@query("topic_catalog")
def topic_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return off.topic_catalog(envelope(spark, sf_dir))


@query("partition_offsets")
def partition_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return off.partition_offsets(envelope(spark, sf_dir))


def _lag(spark, sf_dir):
    env = envelope(spark, sf_dir)
    return off.consumer_lag(off.partition_offsets(env), fixtures.committed_offsets(env))


@query("consumer_lag")
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag(spark, sf_dir)


@query("consumer_lag_total")
def consumer_lag_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return off.lag_totals(_lag(spark, sf_dir))


@query("ingest_rate_by_minute")
def ingest_rate_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per topic and minute of their time, and per second."""
    from ..streaming.progress import rate_by_window

    return rate_by_window(envelope(spark, sf_dir))


def _part_of(offset, last: int, i: int):
    """The i-th third of the offsets up to ``last``."""
    return (offset > (last * i // 3 if i else -1)) & (offset <= last * (i + 1) // 3)


def _consumed_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """A consumer with recorded progress that runs three times; each time the next
    third of the records has already arrived. Returns the progress table's path."""
    from ..streaming import ingest, progress

    run = _run_dir(spark, "lag")
    records = _topic_records(spark, sf_dir).withColumn("partition", (F.col("offset") % 3).cast("int"))
    last = records.agg(F.max("offset")).first()[0] or 0
    sink = progress.with_progress(ingest.envelope_access_log_sink(f"{run}/raw", f"{run}/rejects", ONE_DAY), f"{run}/progress",
                                  lambda: off.partition_offsets(spark.read.parquet(f"{run}/arrived")))
    parts = [records.where(_part_of(F.col("offset"), last, i)) for i in range(3)]
    parts[0].write.mode("append").parquet(f"{run}/arrived")
    for i in range(3):
        parts[i].write.mode("append").parquet(f"{run}/topic")
        if i < 2:
            parts[i + 1].write.mode("append").parquet(f"{run}/arrived")
        ingest.start(spark.readStream.schema(records.schema).parquet(f"{run}/topic"), sink, f"{run}/checkpoint").awaitTermination()
    return f"{run}/progress"


@query("lag_trend")
def lag_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of a running consumer per batch and partition, and its change."""
    from ..streaming import progress

    return progress.lag_trend(progress.progress(spark, _consumed_in_parts(spark, sf_dir))).drop("batches_left")


@query("consumer_lag_recorded")
def consumer_lag_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of that consumer against all records, from the offsets it has committed."""
    from ..streaming import progress

    run = _consumed_in_parts(spark, sf_dir)
    records = _topic_records(spark, sf_dir).withColumn("partition", (F.col("offset") % 3).cast("int"))
    early = progress.progress(spark, run).where("batch_id < 2").groupBy("topic", "partition").agg(F.max("committed").alias("committed"))
    return off.consumer_lag(off.partition_offsets(records), early)


# --- streaming ingest ----------------------------------------------------------------

def _run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder per run: a new checkpoint always gets a new output path."""
    import uuid
    return work_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:10]}")


@query("stream_access_log")
def stream_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files dropped in a landing folder, ingested by a streaming query
    (availableNow) into the raw table; returns what was loaded."""
    from ..streaming import ingest

    landing = derived_path(spark, "trading_landing", [_path(sf_dir, "events")],
                           # a large day is several files
                           lambda: day_lines(spark, sf_dir).repartitionByRange("file_name", "line_no")
                           .select("file_name", "line"),
                           partition_by=["file_name"])
    run = _run_dir(spark, "stream-access")
    q = ingest.ingest_access_log(spark, landing, f"{run}/raw", f"{run}/rejects", f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)


@query("stream_app_log")
def stream_app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application log ingested by a streaming query into app_logs."""
    from ..streaming import ingest

    landing = derived_path(spark, "app_landing", [_path(sf_dir, "events")],
                           lambda: app_lines(spark, sf_dir).select("line"))
    run = _run_dir(spark, "stream-app")
    q = ingest.ingest_app_log(spark, landing, f"{run}/raw", f"{run}/rejects", f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/raw").select(*ap.FIELDS)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_lines(spark, sf_dir).select("file_name", "line_no", "line")


def _write_batch(spark: SparkSession, lines: DataFrame, run: str, feed: str, batch_id: int) -> str:
    from ..streaming import ingest

    ingest.access_log_sink(f"{run}/{feed}/raw", f"{run}/{feed}/rejects")(lines.select("file_name", "line"), batch_id)
    return f"{run}/{feed}/raw"


@query("stream_topic_access_log")
def stream_topic_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All login and logout lines as topic records of one day, read by the
    consumer: every record is parsed, also those without ``cid:``."""
    from ..sources.files import lines_to_envelope
    from ..streaming import ingest

    lines = day_lines(spark, sf_dir).where(F.col("line").contains(": log"))
    run = _run_dir(spark, "stream-topic")
    records = lines_to_envelope(lines, topic="trading-access-logs").withColumn("partition", F.lit(0))
    records.write.parquet(f"{run}/topic")
    q = ingest.ingest_topic_access_log(
        spark.readStream.schema(records.schema).parquet(f"{run}/topic"), f"{run}/raw", f"{run}/rejects",
        f"{run}/checkpoint", ONE_DAY)
    q.awaitTermination()
    return spark.read.parquet(f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)


def _topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login lines as keyed topic records: offset = arrival position."""
    return trading_topic(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
        F.lit("trading-access-logs").alias("topic"), F.col("partition").cast("int").alias("partition"),
        F.col("line_no").cast("long").alias("offset"), F.timestamp_seconds(F.col("line_no")).alias("timestamp"),
        F.lit(0).alias("timestampType"))


@query("stream_once_per_record")
def stream_once_per_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every login record is sent twice, within one batch, in a later one and after a
    restart of the consumer; each is stored once."""
    from ..streaming import ingest

    run = _run_dir(spark, "once")
    records = _topic_records(spark, sf_dir)
    third = F.col("offset") % 3

    def deliver(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{run}/topic")

    def consume() -> None:
        stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 4).parquet(f"{run}/topic")
        ingest.ingest_topic_access_log(stream, f"{run}/raw", f"{run}/rejects", f"{run}/checkpoint", ONE_DAY,
                                       once_by="offset").awaitTermination()

    deliver(records.where(third < 2).union(records.where(third == 0)))  # a third twice at once
    consume()
    deliver(records.where(third == 2))
    deliver(records.where(third > 0))  # the rest again
    consume()
    return spark.read.parquet(f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)


@query("stream_login_order")
def stream_login_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per login, the position of each of its messages, numbered by a stream that
    gets them in three batches with a restart between."""
    from ..streaming import ingest
    from ..streaming.state import sequence_numbers

    run = _run_dir(spark, "order")
    records = _topic_records(spark, sf_dir)
    last = records.agg(F.max("offset")).first()[0] or 0
    for i in range(3):
        part = records.where(_part_of(F.col("offset"), last, i))
        part.write.mode("append").parquet(f"{run}/topic")
        numbered = sequence_numbers(spark.readStream.schema(records.schema).parquet(f"{run}/topic"))
        q = ingest.start(numbered, lambda df, n: df.write.mode("overwrite").parquet(f"{run}/seq/batch={n}"), f"{run}/checkpoint")
        q.awaitTermination()
    return spark.read.parquet(f"{run}/seq").select("key", F.col("offset").alias("line_no"), "seq")


@query("stream_growing_file")
def stream_growing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files that grow while a stream follows them: half of each is there, the
    stream runs, the rest is appended (the first append ends in the middle of a
    line), and the stream runs again from its checkpoint. Each line arrives once."""
    from ..sources.tail import tail_stream
    from ..streaming import ingest

    run = _run_dir(spark, "growing")
    sink = ingest.access_log_sink(f"{run}/raw", f"{run}/rejects")

    def follow() -> None:
        q = ingest.start(tail_stream(spark, f"{run}/logs"), sink, f"{run}/checkpoint")
        q.awaitTermination()

    lines = _landed(spark, sf_dir)
    for step in range(3):
        fixtures.grow_day_files(lines, f"{run}/logs", step, 3)
        follow()
    return spark.read.parquet(f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)


@query("stream_counters")
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that the landing-folder ingest writes, summed over its batches."""
    from ..streaming import ingest

    run = _run_dir(spark, "stream-counters")
    day_lines(spark, sf_dir).select("file_name", "line").write.partitionBy("file_name").text(f"{run}/landing")
    q = ingest.ingest_access_log(spark, f"{run}/landing", f"{run}/raw", f"{run}/rejects", f"{run}/checkpoint",
                                 max_files_per_trigger=64, counters_path=f"{run}/counters")
    q.awaitTermination()
    names = ("lines", "sent", "skipped", "inserted", "rejected")
    return spark.read.parquet(f"{run}/counters").agg(*[F.sum(c).alias(c) for c in names])


@query("undated_rejects")
def undated_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a landing file without a date in its name: none is loaded, each
    login line is a reject with its whole text."""
    run = _run_dir(spark, "undated")
    lines = _landed(spark, sf_dir).withColumn("file_name", F.lit("trading_today.log"))
    _write_batch(spark, lines, run, "a", 0)
    rej = spark.read.parquet(f"{run}/a/rejects")
    return rej.groupBy("reason", "topic").agg(F.count(F.lit(1)).alias("lines"),
                                              F.count_if(F.col("raw").contains("cid:")).alias("whole_lines"))


@query("raw_compacted")
def raw_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder ingested in many small batches, then compacted: same rows."""
    from ..streaming import ingest
    from .compact import compact_raw, raw_rows

    run = _run_dir(spark, "compact")
    lines = _landed(spark, sf_dir).withColumn("file_name", F.lit(f"trading_{ONE_DAY}.log"))
    sink = ingest.access_log_sink(f"{run}/raw", f"{run}/rejects")
    for n in range(6):
        sink(lines.where(F.col("line_no") % 6 == n).select("file_name", "line"), n)
    compact_raw(spark, f"{run}/raw")
    return raw_rows(spark, f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)


#: Queries of a single day take all lines as that day's.
ONE_DAY = "20310705"


def _two_feeds(spark: SparkSession, sf_dir: str) -> tuple[str, list[str], str]:
    """All lines as one day's, dealt to two raw paths that both start at batch
    0, and the day file."""
    run = _run_dir(spark, "close")
    day = f"trading_{ONE_DAY}.log"
    lines = _landed(spark, sf_dir).withColumn("file_name", F.lit(day))
    raws = [_write_batch(spark, lines.where(F.col("line_no") % 2 == i), run, f"feed{i}", 0) for i in (0, 1)]
    lines.select("line").write.text(f"{run}/logs/{day}")
    return run, raws, f"{run}/logs/{day}"


@query("close_day_two_feeds")
def close_day_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day closed twice through the stored tables: first with one feed, then
    with both. Batches of both feeds are numbered 0."""
    from .eod_job import close_day

    run, raws, day_file = _two_feeds(spark, sf_dir)
    close_day(spark, ONE_DAY, day_file, raws[:1], f"{run}/table")
    close_day(spark, ONE_DAY, day_file, raws, f"{run}/table")
    return spark.read.parquet(f"{run}/table").select(*al.ACCESS_LOG_COLUMNS)


@query("close_day_late_row")
def close_day_late_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day closed, then closed again when a few late rows have arrived: the
    second close writes those rows only. ``close_no`` tells which one set a flag."""
    from .eod_job import close_day, closed_rows

    run = _run_dir(spark, "late")
    day = f"trading_{ONE_DAY}.log"
    lines = _landed(spark, sf_dir).withColumn("file_name", F.lit(day))
    lines.select("line").write.text(f"{run}/logs/{day}")
    late = F.col("line_no") % 97 == 5
    for batch_id, part in enumerate((lines.where(~late), lines.where(late))):
        raw = _write_batch(spark, part, run, "feed", batch_id)
        close_day(spark, ONE_DAY, f"{run}/logs/{day}", raw, f"{run}/table")
    return closed_rows(spark, f"{run}/table").select(
        *al.ACCESS_LOG_COLUMNS, F.substring_index("close", "-", 1).cast("int").alias("close_no"))


@query("pending_after_close")
def pending_after_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrived after a day was closed, found without reading closed rows."""
    from .eod_job import close_day, pending_rows

    run, raws, day_file = _two_feeds(spark, sf_dir)
    close_day(spark, ONE_DAY, day_file, raws[:1], f"{run}/table")
    iso = f"{ONE_DAY[:4]}-{ONE_DAY[4:6]}-{ONE_DAY[6:]}"
    return pending_rows(spark, raws, f"{run}/table", iso).select(*al.ACCESS_LOG_COLUMNS)


@query("close_day_folded")
def close_day_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day closed once per feed, then folded into one sorted set of files."""
    from .eod_job import close_day, closed_rows, fold_day

    run, raws, day_file = _two_feeds(spark, sf_dir)
    close_day(spark, ONE_DAY, day_file, raws[:1], f"{run}/table")
    close_day(spark, ONE_DAY, day_file, raws, f"{run}/table")
    fold_day(spark, ONE_DAY, f"{run}/table")
    return closed_rows(spark, f"{run}/table").select(*al.ACCESS_LOG_COLUMNS)


@query("close_day_empty")
def close_day_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of closing a day whose access rows never arrived: the day file
    is scanned, and one row reports zero changes."""
    from .eod_job import close_day

    run = _run_dir(spark, "empty")
    day_file = f"{run}/logs/trading_{ONE_DAY}.log"
    _landed(spark, sf_dir).select("line").write.text(day_file)
    return close_day(spark, ONE_DAY, day_file, f"{run}/nothing", f"{run}/empty_table")


#: The encoding of a day file, by the remainder of its day of the month.
ENCODINGS = ["UTF-8", "UTF-16LE", "UTF-16BE"]
#: Characters with a byte 0A, and a pair that holds the bytes of a little-endian newline.
WIDE_TEXT = "\t\u5317\u4e0a \u0a85\u4e00"


def _encoded_days(spark: SparkSession, sf_dir: str, run: str, lines: DataFrame, kinds: list[str]) -> str:
    day = F.dayofmonth(F.to_date(F.substring("file_name", 9, 8), "yyyyMMdd"))
    for i, kind in enumerate(kinds):
        fixtures.write_day_files(lines.where(day % len(kinds) == i), f"{run}/logs", kind)
    return f"{run}/logs"


@query("utf16_day_scan")
def utf16_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade IPs per day from a folder where every other day file is UTF-16."""
    from ..sources.files import read_lines

    run = _run_dir(spark, "utf16")
    return eod.scan_summary(read_lines(spark, _encoded_days(spark, sf_dir, run, _landed(spark, sf_dir), ENCODINGS[:2])))


@query("mixed_encoding_scan")
def mixed_encoding_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files in UTF-8, UTF-16LE and UTF-16BE in one folder, whose lines all end
    with characters that hold a newline's bytes: per file, lines scanned,
    trade IPs and lines that end as they were written."""
    from ..sources.files import read_lines

    run = _run_dir(spark, "mixed")
    ended = _landed(spark, sf_dir).withColumn("line", F.concat("line", F.lit(WIDE_TEXT)))
    lines = read_lines(spark, _encoded_days(spark, sf_dir, run, ended, ENCODINGS))
    whole = lines.groupBy("file_name").agg(F.count_if(F.endswith("line", F.lit(WIDE_TEXT))).alias("whole_lines"))
    return eod.scan_summary(lines).join(whole, "file_name")


@query("stream_mixed_encodings")
def stream_mixed_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as a landing stream, loaded into the raw table."""
    from ..streaming import ingest

    run = _run_dir(spark, "stream-mixed")
    landing = _encoded_days(spark, sf_dir, run, _landed(spark, sf_dir), ENCODINGS)
    q = ingest.ingest_access_log(spark, landing, f"{run}/raw", f"{run}/rejects", f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/raw").select(*al.ACCESS_LOG_COLUMNS)
