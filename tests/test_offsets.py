"""Offsets, lag and partitioning (FIXTURES §3.5, §3.6)."""

import random
import zlib

from pyspark.sql import functions as F

from loglane.functions.sequence import dense_rank_in_groups
from loglane.operators import offsets as off


def test_lag_vector(spark):
    wm = spark.createDataFrame([("t", 0, 0, 15), ("t", 1, 0, 7), ("t", 2, 0, 9), ("t", 3, 0, 4)],
                               "topic string, partition int, low bigint, high bigint")
    cm = spark.createDataFrame([("t", 0, 10), ("t", 1, -1001), ("t", 2, 9)],
                               "topic string, partition int, committed bigint")
    lag = off.consumer_lag(wm, cm)
    got = {r["partition"]: (r["lag"], r["status"]) for r in lag.collect()}
    assert got == {0: (5, "BEHIND by 5"), 1: (7, "BEHIND by 7"), 2: (0, "OK"), 3: (4, "BEHIND by 4")}
    tot = {(r["topic"], r["partition"]): r["total_lag"] for r in off.lag_totals(lag).collect()}
    assert tot[(None, None)] == 16 and tot[("t", None)] == 16


def test_lag_labels(spark):
    df = spark.createDataFrame([(12345,), (0,)], "lag bigint")
    r = df.select(off.lag_status(F.col("lag")).alias("a"), off.lag_status(F.col("lag"), "app").alias("b")).collect()
    assert (r[0]["a"], r[0]["b"]) == ("BEHIND by 12,345", "BEHIND by 12345 messages")
    assert (r[1]["a"], r[1]["b"]) == ("OK", "OK - caught up")


def test_internal_topics_hidden(spark):
    env = spark.createDataFrame([("__consumer_offsets", 0, 1), ("b", 0, 0), ("b", 1, 0), ("a", 0, 5)],
                                "topic string, partition int, offset bigint")
    assert [tuple(r) for r in off.topic_catalog(env).collect()] == [("a", 1), ("b", 2)]


def test_key_partition_is_crc32(spark):
    keys = ["11820785"] + [str(11000000 + i) for i in range(300)] + ["", "abc"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["p"] for r in df.select("k", off.key_partition(F.col("k")).alias("p")).collect()}
    assert got["11820785"] == 2
    assert all(got[k] == zlib.crc32(k.encode()) % 3 for k in keys)


def test_registered_key_partition_matches_zlib(spark):
    from loglane.plans.queries import REGISTRY
    rows = REGISTRY["key_partition"](spark, "/root/testdata/sf0.001").collect()
    keyed = [r for r in rows if r["key"] is not None]
    assert keyed and all(r["partition"] == zlib.crc32(r["key"].encode()) % 3 for r in keyed)
    assert [r["partition"] for r in rows if r["key"] is None] == [None]
    assert len({r["key"] for r in rows}) == len(rows)


def test_dense_rank_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b"]), rnd.randrange(1, 3), n) for n in rnd.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "g string, h int, o bigint")
    got = {(r["g"], r["h"], r["o"]): r["pos"] for r in dense_rank_in_groups(df, ["g", "h"], "o", "pos", 37).collect()}
    want = {}
    for key in {(g, h) for g, h, _ in rows}:
        for i, o in enumerate(sorted(o for g, h, o in rows if (g, h) == key)):
            want[key + (o,)] = i
    assert got == want


def test_progress_offsets(spark):
    doc = '{"sources": [{"endOffset": {"trading-access-logs": {"0": 14823, "1": 14901, "2": 14876}}}]}'
    got = sorted(tuple(r) for r in off.progress_offsets(spark, doc).collect())
    assert got == [("trading-access-logs", 0, 14823), ("trading-access-logs", 1, 14901), ("trading-access-logs", 2, 14876)]


def test_checkpoint_offsets(spark, tmp_dir):
    import os
    ck = os.path.join(tmp_dir, "ck")
    os.makedirs(os.path.join(ck, "offsets"))
    os.makedirs(os.path.join(ck, "commits"))
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":1,"conf":{}}'
    for b, offs in ((0, (10, 20, 30)), (1, (14823, 14901, 14876)), (2, (99999, 99999, 99999))):
        with open(os.path.join(ck, "offsets", str(b)), "w") as fh:
            fh.write("v1\n" + meta + "\n" + '{"trading-access-logs":{"0":%d,"1":%d,"2":%d}}' % offs)
    for b in (0, 1):  # batch 2 was planned but never committed
        with open(os.path.join(ck, "commits", str(b)), "w") as fh:
            fh.write('v1\n{"nextBatchWatermarkMs":0}')
    got = sorted(tuple(r) for r in off.checkpoint_offsets(spark, ck).collect())
    assert got == [("trading-access-logs", 0, 14823), ("trading-access-logs", 1, 14901),
                   ("trading-access-logs", 2, 14876)]
    assert off.checkpoint_offsets(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_checkpoint_offsets_of_a_file_stream(spark, tmp_dir):
    import os
    from loglane.plans.queries import day_lines
    from loglane.streaming import ingest
    landing = os.path.join(tmp_dir, "landing")
    day_lines(spark, "/root/testdata/sf0.001").limit(50).select("file_name", "line") \
        .write.partitionBy("file_name").text(landing)
    ck = os.path.join(tmp_dir, "ck")
    ingest.ingest_access_log(spark, landing, os.path.join(tmp_dir, "r"), os.path.join(tmp_dir, "j"), ck) \
        .awaitTermination()
    assert off.checkpoint_offsets(spark, ck).count() == 0  # file sources have no partition offsets
