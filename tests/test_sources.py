"""Text sources, encodings, dates and connector option building (§3.6)."""

import datetime as dt
import io
import os

from pyspark.sql import functions as F

from loglane.functions import dates
from loglane.functions.text import PY_WHITESPACE, ustrip, ws_token
from loglane.sources import files, jdbc, kafka


def test_dates(spark):
    df = spark.createDataFrame([("20260318",), ("2026031",), ("20261345",)], "s string")
    got = [r[0] for r in df.select(dates.date_from_compact("s")).collect()]
    assert got == [dt.date(2026, 3, 18), None, None]
    f = spark.createDataFrame([("/x/trading_20260318.log",), ("app.log",)], "f string")
    assert [r[0] for r in f.select(dates.date_from_file_name("f")).collect()] == [dt.date(2026, 3, 18), None]
    assert dates.day_file_for("20260318") == "trading_20260318.log"
    assert dates.iso_from_compact("20260318") == "2026-03-18"


def test_python_whitespace(spark):
    samples = ["  a b  ", " x y\x1c", "\t\n", "", "a​b", " 　q\x85"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(ustrip("s").alias("st"), *[ws_token("s", i).alias(f"t{i}") for i in range(4)]).collect()
    for s, r in zip(samples, got):
        assert r["st"] == s.strip() and [r[f"t{i}"] for i in range(4) if r[f"t{i}"] is not None] == s.split(), repr(s)
    assert set(PY_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_lossy_utf8_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trading_20260318.log")
    with open(p, "wb") as fh:
        fh.write(b"a\n\nb\xffc\n")
    got = [r["line"] for r in files.read_lines(spark, p).collect()]
    assert got == ["a", "", "bc"]
    assert files.detect_encoding(spark, p) == "UTF-8"


def test_utf16_big_endian(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trading_20260319.log")
    with open(p, "wb") as fh:
        fh.write(b"\xfe\xff" + "a b\n\nc\n".encode("utf-16-be"))
    assert files.detect_encoding(spark, p) == "UTF-16BE"
    assert [r["line"] for r in files.read_lines(spark, p).collect()] == ["a b", "", "c"]


def test_utf16_day_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trading_20260318.log")
    text = "XA\t0\t6\t00:00:00.1\t1.2.3.4\t'7': order placed\nsecond line é\n\nthird\r\nlast"
    with io.open(p, "w", encoding="utf-16") as fh:
        fh.write(text)
    assert files.detect_encoding(spark, p).startswith("UTF-16")
    df = files.read_day_file(spark, p)
    first = "XA\t0\t6\t00:00:00.1\t1.2.3.4\t'7': order placed"
    assert [r["line"] for r in df.collect()] == [first, "second line é", "", "third", "last"]
    assert {r["file_name"] for r in df.collect()} == {"trading_20260318.log"}


def test_envelope_roundtrip(spark):
    lines = spark.createDataFrame([("trading_20260318.log", "x,y")], "file_name string, line string")
    env = files.lines_to_envelope(lines)
    r = files.envelope_lines(env).first()
    assert (r["topic"], r["line"]) == ("trading_20260318", "x,y")
    bad = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "value binary")
    assert files.envelope_lines(bad.select("value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                                           F.lit(1).cast("bigint").alias("offset"))).first()["line"] is None


def test_connector_options():
    o = kafka.source_options("b:9092", "trading-access-logs", min_offsets_per_trigger=500, max_trigger_delay="3s")
    assert o["subscribe"] == "trading-access-logs" and o["startingOffsets"] == "earliest"
    assert (o["minOffsetsPerTrigger"], o["maxTriggerDelay"]) == ("500", "3s")
    s = kafka.sink_options("b:9092", "t", linger_ms=50, batch_size=65536)
    assert (s["kafka.linger.ms"], s["kafka.batch.size"]) == ("50", "65536")
    j = jdbc.jdbc_options("jdbc:postgresql://h/db", "s.access_log", "u", "p")
    assert j["batchsize"] == "500" and j["dbtable"] == "s.access_log"


def test_records_shape(spark):
    from loglane.operators.orders import decode_orders, encode_orders
    rows = spark.createDataFrame([(1, "customer_1", "widget", 2)], "order_id bigint, customer string, item string, quantity bigint")
    rec = kafka.to_records(encode_orders(rows), "value", "key").first()
    assert rec["key"] == "1" and rec["value"] == '{"order_id":1,"customer":"customer_1","item":"widget","quantity":2}'
    bad = spark.createDataFrame([("{oops",), ('{"customer":"x"}',)], "value string")
    assert [r["reason"] for r in decode_orders(bad).collect()] == ["not an order message"] * 2


def test_read_lines_from_folder(spark, tmp_dir):
    for name in ("trading_20260318.log", "trading_20260319.log"):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write("a\nb\n")
    assert files.detect_encoding(spark, tmp_dir) == "UTF-8"
    df = files.read_lines(spark, tmp_dir)
    assert sorted(r["file_name"] for r in df.collect()) == ["trading_20260318.log"] * 2 + ["trading_20260319.log"] * 2


LINES = ["XA\t0\t6\tt\t1.2.3.4\t'7': order placed", "é ж 日本 \U0001f600", "last"]


def _mixed_folder(folder):
    """The same lines in three encodings, each file with malformed bytes in its second line."""
    text = "\n".join(LINES)
    cut = text.index("\n") + 1
    for name, enc, mark, bad in (("trading_20260318.log", "utf-8", b"", b"\xff"),
                                 ("trading_20260319.log", "utf-16-le", b"\xff\xfe", b"\x00\xd8"),
                                 ("trading_20260320.log", "utf-16-be", b"\xfe\xff", b"\xdc\x00")):
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(mark + text[:cut].encode(enc) + bad + text[cut:].encode(enc))


def test_folder_of_mixed_encodings_with_malformed_units(spark, tmp_dir):
    _mixed_folder(tmp_dir)
    want = sorted((f"trading_202603{d}.log", x) for d in (18, 19, 20) for x in LINES)
    assert sorted((r["file_name"], r["line"]) for r in files.read_lines(spark, tmp_dir).collect()) == want
    for d in (18, 19, 20):
        one = files.read_day_file(spark, os.path.join(tmp_dir, f"trading_202603{d}.log"))
        assert [r["line"] for r in one.collect()] == LINES


def test_landing_stream_of_mixed_encodings(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _mixed_folder(landing)
    q = (files.landing_stream(spark, landing).writeStream.format("memory").queryName("mixed")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["file_name"], r["line"]) for r in spark.table("mixed").collect())
    assert got == sorted((f"trading_202603{d}.log", x) for d in (18, 19, 20) for x in LINES)
