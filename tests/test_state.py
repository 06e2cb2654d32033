"""Records once, and their order per key, across batches and restarts."""

import os

import pytest
from pyspark.sql import functions as F

from loglane.schemas import ENVELOPE
from loglane.streaming import ingest, state

COLUMNS = "key string, value string, topic string, partition int, offset long, timestamp timestamp, timestampType int"


def _records(spark, rows):
    """rows: (key, value, partition, offset)"""
    df = spark.createDataFrame([(k, v, "t", p, o, None, 0) for k, v, p, o in rows], COLUMNS)
    return df.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "partition", "offset", "timestamp", "timestampType")


def _run(spark, tmp_dir, stages, op, name):
    src, out, ck = (os.path.join(tmp_dir, name + x) for x in ("-src", "-out", "-ck"))
    for rows in stages:
        _records(spark, rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src)
        ingest.start(op(stream), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/n={n}"), ck).awaitTermination()
    return spark.read.parquet(out)


def test_records_by_offset(spark, tmp_dir):
    a = [("k", f"v{i}", i % 3, i) for i in range(20)]
    b = [("k", f"v{i}", i % 3, i) for i in range(15, 30)]
    got = _run(spark, tmp_dir, [a + a[:7], b, a], state.once_per_record, "off")
    assert sorted(r["offset"] for r in got.collect()) == list(range(30))
    # the same text under another offset is another record; without offsets the content counts
    more = [("k", "same", 0, 1), ("k", "same", 0, 2), (None, "x", None, None), (None, "x", None, None), (None, None, None, None), ("k", "x", None, None)]
    assert _run(spark, tmp_dir, [more, more], state.once_per_record, "none").count() == 5


def test_records_by_value(spark, tmp_dir):
    sent = [("k", "one", 0, 1), ("k", "one", 0, 2), ("j", "one", 0, 3), ("k", None, 1, 4)]
    again = [("k", "one", 2, 9), ("k", "two", 2, 10), ("k", None, 2, 11)]
    got = _run(spark, tmp_dir, [sent, again], lambda s: state.once_per_record(s, "value"), "val")
    rows = sorted((bytes(r["key"]).decode(), r["value"] and bytes(r["value"]).decode()) for r in got.collect() if r["value"])
    assert rows == [("j", "one"), ("k", "one"), ("k", "two")] and got.where("value is null").count() == 1
    assert state.once_per_record(_records(spark, sent), "value").count() == 3  # a batch
    with pytest.raises(ValueError):
        state.record_identity("line")


def test_sequence_over_batches(spark, tmp_dir):
    """A key with most rows, an unkeyed group and an empty key; three batches, two restarts."""
    rows = [("hot" if i % 3 else [None, "", "b"][i // 3 % 3], f"v{i}", 0, i) for i in range(300)]
    stages = [rows[:100], rows[100:130], rows[130:]]
    got = _run(spark, tmp_dir, [list(reversed(s)) for s in stages], state.sequence_numbers, "seq")
    want, seen = set(), {}
    for k, _, p, o in rows:
        want.add((k, p, o, seen.setdefault(k, 0)))
        seen[k] += 1
    assert {(r["key"], r["partition"], r["offset"], r["seq"]) for r in got.collect()} == want
    assert got.count() == len(rows)


def test_ingest_stores_a_resent_record_once(spark, tmp_dir):
    line = "Q\t4\t3\t00:00:09.000\t5.6.7.8\t'8': login (Terminal build 1, cid: c1, point: P, ping: 1 ms)"
    base = os.path.join(tmp_dir, "once")
    for rows in ([("8", line, 0, 5)], [("8", line, 0, 5), ("8", line, 0, 6)]):
        _records(spark, rows).coalesce(1).write.mode("append").parquet(base + "-src")
        ingest.ingest_topic_access_log(spark.readStream.schema(ENVELOPE).parquet(base + "-src"), base + "-raw", base + "-rej",
                                       base + "-ck", "20260318", once_by="offset").awaitTermination()
    assert spark.read.parquet(base + "-raw").count() == 2
