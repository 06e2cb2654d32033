"""Producer records and topic consumers over envelope streams (Parquet files
in the topic envelope shape stand in for the Kafka source)."""

import os
import zlib

from pyspark.sql import functions as F

from loglane.operators import app_log as ap
from loglane.plans.queries import REGISTRY, app_lines, day_lines, order_messages
from loglane.schemas import ENVELOPE
from loglane.streaming import ingest, produce

SF = "/root/testdata/sf0.001"


def _as_envelope(records, topic, partitions=3):
    """(key, value[, partition]) text records -> envelope rows with offsets."""
    part = F.col("partition") if "partition" in records.columns else F.lit(0)
    return records.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                          F.lit(topic).alias("topic"), part.cast("int").alias("partition"),
                          F.monotonically_increasing_id().alias("offset"),
                          F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))


def test_trading_records(spark):
    recs = produce.trading_records(day_lines(spark, SF), partitions=3)
    rows = recs.collect()
    assert len(rows) == REGISTRY["cid_filter"](spark, SF).count()
    assert all(r["partition"] == (None if r["key"] is None else zlib.crc32(r["key"].encode()) % 3) for r in rows)
    assert any(r["key"] is None for r in rows) and any(r["key"] is not None for r in rows)
    assert all("cid:" in r["value"] and r["value"] == r["value"].strip() for r in rows)


def test_app_topic_roundtrip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "topic")
    env = _as_envelope(produce.app_records(app_lines(spark, SF)), "app-logs")
    bad = spark.createDataFrame([(None, bytearray(b"\xc3\x28"), "app-logs", 0, 99999, None, 0)], ENVELOPE)
    env.unionByName(bad.withColumn("timestamp", F.current_timestamp())).write.parquet(src)
    raw, rej, ck = (os.path.join(tmp_dir, x) for x in ("raw", "rej", "ck"))
    ingest.ingest_topic_app_log(spark.readStream.schema(ENVELOPE).parquet(src), raw, rej, ck).awaitTermination()
    got = spark.read.parquet(raw).select(*ap.FIELDS)
    want = REGISTRY["app_log_typed"](spark, SF).select(*ap.FIELDS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    reasons = [r["reason"] for r in spark.read.parquet(rej).where("offset = 99999").collect()]
    assert reasons == [ingest.MISSING_VALUE]


def test_orders_topic_roundtrip(spark, tmp_dir):
    msgs = order_messages(spark, SF)
    env = msgs.select("key", "value", F.lit("orders").alias("topic"), F.lit(0).alias("partition"),
                      F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
                      F.lit(0).alias("timestampType"))
    bad = spark.createDataFrame([(bytearray(b"1"), bytearray(b"{oops"), "orders", 1, 7, None, 0)], ENVELOPE)
    src = os.path.join(tmp_dir, "orders")
    env.unionByName(bad.withColumn("timestamp", F.current_timestamp())).write.parquet(src)
    out, rej, ck = (os.path.join(tmp_dir, x) for x in ("out", "rej", "ck"))
    ingest.ingest_orders(spark.readStream.schema(ENVELOPE).parquet(src), out, rej, ck).awaitTermination()
    got = spark.read.parquet(out).select("key", "order_id", "customer", "item", "quantity")
    want = REGISTRY["orders_json_decode"](spark, SF)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    r = spark.read.parquet(rej).first()
    assert (r["offset"], r["reason"], r["raw"]) == (7, "not an order message", "{oops")
