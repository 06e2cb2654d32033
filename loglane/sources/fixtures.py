"""Raw log lines and messages rendered from the warehouse tables.

The reference consumes text written by log servers; the test warehouse holds
typed rows. These functions render those rows into the reference's line
formats with native expressions, so every query reads the given tables and
its work grows with them. Every value is an integer or fixed text, so an
independent SQL engine can compute the expected parse results from the
columns without parsing anything.

Trading day files (one per ``CAST(ts AS DATE)``):
  click, view -> login line   signup -> logout line
  purchase    -> trade line   error  -> system line
App log: one line per event. Orders: one JSON message per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_file_name
from ..operators.app_log import severity


def _pick(idx: Column, options: list[Column | str]) -> Column:
    out = None
    for i, o in enumerate(options):
        o = F.lit(o) if isinstance(o, str) else o
        out = F.when(idx == i, o) if out is None else out.when(idx == i, o)
    return out


def _s(c: Column) -> Column:
    return c.cast("string")


# Fixed values of the rendering, chosen here (the oracle checks device and
# geo effects). Geo texts contain commas; "Border" holds "order", a false
# trade hit on a login line (kept for parity). No other value contains a trade
# keyword or "investor".
CLIENTS = ["Terminal Alpha", "Terminal Beta", "Terminal"]
BUILDS = [" build 11", " build 22", " build 33"]
GEOS = ["SG, Singapore, Harbour Net", "DE, Hamburg, Border Telecom",
        "BR, Recife, Rio Link, RL", "KE, Nairobi, Savanna ISP"]
LONG_DEVICE = "Terminal " + "Q" * 120 + " build 1"

# Awkward lines, by the remainder of ``event_id``. Those of login lines are odd,
# so never on the even ids of investor and long-device lines.
NO_BUILD = (40, 11)   # client text without "build"
UNKEYED = (60, 21)    # empty login: no message key
SHORT = (70, 31)      # message ends after cid: the strict parse pads
SENTINEL = (48, 22)   # trade line whose login token is "unknown"


def is_variant(e: Column, variant: tuple[int, int]) -> Column:
    return e % variant[0] == variant[1]


def ip_of(user_id: Column) -> Column:
    return F.concat(F.lit("10.0.0."), _s(F.floor(user_id / 3)))


def login_of(user_id: Column) -> Column:
    return _s(user_id + F.lit(11000000))


def _pad(line: Column) -> Column:
    """Some lines carry stray whitespace (leading space, trailing tab+NBSP)."""
    e = F.col("event_id")
    return F.when(e % 7 == 3, F.concat(F.lit(" "), line, F.lit("\t\u00a0"))).otherwise(line)


def trading_lines(events: DataFrame) -> DataFrame:
    """events -> (file_name, line_no, line): the day files of the trading
    server. ``line_no`` is the arrival position (events are appended in
    ``event_id`` order)."""
    e = F.col("event_id")
    ip = ip_of(F.col("user_id"))
    login = login_of(F.col("user_id"))
    q = F.concat(F.lit("'"), login, F.lit("'"))
    t = F.date_format("ts", "HH:mm:ss.SSS")
    code = F.concat(F.char(F.lit(65) + e % 26), F.char(F.lit(65) + F.floor(e / 26) % 26))

    def head(a: str, b: str, src: Column) -> Column:
        return F.concat_ws("\t", code, F.lit(a), F.lit(b), t, src)

    build = F.when(is_variant(e, NO_BUILD), F.lit("")).otherwise(_pick(e % 3, BUILDS))
    client = F.when(e % 500 == 250, F.lit(LONG_DEVICE)).otherwise(F.concat(_pick(e % 3, CLIENTS), build))
    who = F.when(is_variant(e, UNKEYED), F.lit("''")).otherwise(q)
    details = F.concat(
        F.lit(", point: Gate North "), _s(e % 2 + 1),
        F.lit(", ping: "), _s(e % 1500), F.lit(" ms, geo: "), _pick(e % 4, GEOS),
        F.when(e % 9 == 4, F.lit(", via: relay")).otherwise(F.lit("")), F.lit(")"))
    login_line = F.concat(
        head("4", "3", ip), F.lit("\t"), who, F.lit(": login ("), client,
        F.when(e % 12 == 0, F.lit(", investor")).otherwise(F.lit("")),
        F.lit(", cid: "), F.md5(_s(e)),
        F.when(is_variant(e, SHORT), F.lit("")).otherwise(details))
    logout_line = F.concat(head("4", "3", ip), F.lit("\t"), q, F.lit(": logout ("),
                           _pick(e % 3, CLIENTS), F.lit(")"))
    # Every include text, every veto text and one line with neither.
    number = F.concat(F.lit(" #"), _s(e))
    trade_msg = _pick(e % 16, [
        F.concat(F.lit("order placed for execution"), number),
        F.concat(F.lit("modify order"), number),
        F.concat(F.lit("position modified"), number),
        F.concat(F.lit("request from desk for order"), number),
        F.concat(F.lit("buy limit: "), _s(e % 4000 + 1000)),
        F.concat(F.lit("request transferred to dealers"), number),
        F.concat(F.lit("market sell"), number),
        F.concat(F.lit("market buy"), number),
        F.concat(F.lit("order modified"), number),
        F.concat(F.lit("received mail on order"), number),
        F.concat(F.lit("history deals synchronized, order"), number),
        F.concat(F.lit("history orders synchronized"), number),
        F.concat(F.lit("confirm for market buy"), number),
        F.concat(F.lit("modify requested"), number),
        F.concat(F.lit("sell limit "), _s(e % 4000 + 1000)),
        F.concat(F.lit("stop reached"), number),
    ])
    trader = F.when(is_variant(e, SENTINEL), F.lit("unknown")).otherwise(q)
    trade_line = F.concat(head("0", "6", ip), F.lit("\t"), trader, F.lit(": "), trade_msg)
    # neither a login nor a trade: the event's own columns
    system_line = F.concat_ws("\t", code, t, F.col("event_type"), _s(e), _s(F.col("user_id")))
    et = F.col("event_type")
    line = (F.when(et.isin("click", "view"), login_line)
            .when(et == "signup", logout_line)
            .when(et == "purchase", trade_line)
            .otherwise(system_line))
    return events.select(day_file_name(F.to_date("ts")).alias("file_name"),
                         e.alias("line_no"), _pad(line).alias("line"))


def write_day_files(lines: DataFrame, folder: str, encoding: str) -> None:
    """Day files of (file_name, line) under ``folder``, in UTF-8 or in UTF-16 with a
    mark. Big-endian files get theirs from the writer; in little-endian ones each line
    begins with a mark instead of its leading spaces; readers drop the first mark (the
    others are part of the first field)."""
    if encoding == "UTF-8":
        lines.select("file_name", "line").write.mode("append").partitionBy("file_name").text(folder)
        return
    line = F.col("line") if encoding == "UTF-16BE" else F.concat(F.lit("\ufeff"), F.ltrim("line"))
    (lines.select("file_name", line.alias("line")).write.mode("append").partitionBy("file_name")
     .options(encoding="UTF-16" if encoding == "UTF-16BE" else encoding, sep="\x01", quote="", emptyValue="", nullValue="",
              lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder))


def grow_day_files(lines: DataFrame, folder: str, step: int, steps: int) -> int:
    """Day files of (file_name, line_no, line) as they stand after ``step`` of
    ``steps``; before the last, each ends in the middle of a line. A file is written
    anew beside its place, longer each time, and moved there, so a task may be
    repeated. Returns how many files there are."""
    import pyarrow as pa

    from .ranges import ship_package, store_of

    spark = lines.sparkSession
    ship_package(spark)
    last = lines.agg(F.max("line_no")).first()[0] or 0
    now = lines.where(F.col("line_no") <= last * (step + 1) // steps).select("file_name", "line_no", "line")

    def write(batches):
        system, base, _ = store_of(folder)
        system.create_dir(base, recursive=True)
        names, out, held = [], None, b""

        def finish():
            if out is not None:
                out.write(held if step == steps - 1 else held[:len(held) // 2])
                out.close()
                system.move(f"{base}/_{names[-1]}", f"{base}/{names[-1]}")

        for b in batches:
            for name, line in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if not names or name != names[-1]:
                    finish()
                    names.append(name)
                    out, held = system.open_output_stream(f"{base}/_{name}"), b""
                out.write(held)
                held = line.encode() + b"\n"
        finish()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["file_name"])

    return now.repartition("file_name").sortWithinPartitions("file_name", "line_no").mapInArrow(write, "file_name string").count()


def app_log_lines(events: DataFrame) -> DataFrame:
    """events -> (line_no, line): the application server log, with damaged lines.

    Variants by ``event_id % 50``: 1 no separator, 2 repeated ``status``,
    3 non-numeric status, 4 ``level=`` pair, 5 part without ``=``,
    6 empty duration, 7 bad timestamp, 8 empty line."""
    e = F.col("event_id")
    et = F.col("event_type")
    status = (F.when(et == "error", 500).when(et == "click", 404)
              .when(et == "signup", 201).otherwise(200))
    v = e % 50
    ts = F.when(v == 7, F.lit("not-a-time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    line = F.concat(
        ts, F.lit(" | "), F.rpad(severity(status), 5, " "),
        F.lit(" | user_id="), _s(F.col("user_id")),
        F.lit(" | endpoint=/api/"), et,
        F.lit(" | method="), F.when(et.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET")),
        F.lit(" | status="), F.when(v == 3, F.lit("abc")).otherwise(_s(status)),
        F.lit(" | duration_ms="), F.when(v == 6, F.lit("")).otherwise(_s(e % 5000)),
        F.lit(" | ip="), ip_of(F.col("user_id")),
        F.when(status >= 500, F.concat(F.lit(" | error=code=E"), _s(e % 7))).otherwise(F.lit("")),
        F.when(v == 2, F.lit(" | status=777"))
         .when(v == 4, F.lit(" | level=TRACE"))
         .when(v == 5, F.lit(" | junk"))
         .otherwise(F.lit("")))
    line = (F.when(v == 1, F.concat(F.lit("malformed line "), _s(e)))
            .when(v == 8, F.lit(""))
            .otherwise(line))
    return events.select(e.alias("line_no"), _pad(line).alias("line"))


def order_rows(orders: DataFrame) -> DataFrame:
    """orders -> order message fields."""
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("order_id"),
        F.concat(F.lit("customer_"), _s(F.col("o_custkey"))).alias("customer"),
        F.lit("widget").alias("item"),
        (F.lit(2) * (k % 50)).alias("quantity"))


def order_texts(orders: DataFrame) -> DataFrame:
    """orders -> (o_orderkey, value): order messages of which seven in eight are
    damaged, by ``o_orderkey % 8`` (1 mistyped quantity, 2 only an order_id, 3
    text after the object, 4 cut off, 5 not UTF-8, 6 missing, 7 two objects)."""
    k = F.col("o_orderkey")
    good = F.to_json(F.struct(k.alias("order_id"), F.concat(F.lit("customer_"), _s(F.col("o_custkey"))).alias("customer"),
                              F.lit("widget").alias("item"), (F.lit(2) * (k % 50)).alias("quantity")))
    number = F.concat(F.lit('{"order_id":'), _s(k))
    v = k % 8
    text = (F.when(v == 1, F.concat(number, F.lit(',"customer":"c","item":"widget","quantity":"many"}')))
            .when(v == 2, F.concat(number, F.lit("}")))
            .when(v == 3, F.concat(good, F.lit(" and more")))
            .when(v == 4, F.concat(number, F.lit(',"customer":"c')))
            .when(v == 7, F.concat(good, F.lit(","), good))
            .otherwise(good)).cast("binary")
    return orders.select(k, F.when(v == 5, F.unhex(F.lit("FFFE7B"))).when(v != 6, text).alias("value"))


def event_envelope(events: DataFrame) -> DataFrame:
    """events -> message envelopes: topic = event type (``signup`` is renamed
    ``__internal``), partition = ``user_id % 3``, offset = ``event_id``
    (lag needs offsets that grow, not dense ones)."""
    et = F.col("event_type")
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("event_id").cast("string").cast("binary").alias("value"),
        F.when(et == "signup", F.lit("__internal")).otherwise(et).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "event_id")


def committed_offsets(envelope: DataFrame) -> DataFrame:
    """Group progress as data: per (topic, partition), the next offset after
    the last record with ``event_id`` below 90 % of the largest one. The
    (view, 2) partition has no stored progress."""
    cut = envelope.select(F.max("event_id") * 0.9).scalar()
    return (envelope.where(F.col("event_id") < cut)
            .groupBy("topic", "partition")
            .agg((F.max("offset") + 1).alias("committed"))
            .where(~((F.col("topic") == "view") & (F.col("partition") == 2))))
