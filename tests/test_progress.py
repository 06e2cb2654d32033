"""Recorded progress, rates, monthly states, supervision."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loglane.operators import distinct_state as ds
from loglane.operators import offsets as off
from loglane.schemas import ENVELOPE
from loglane.streaming import ingest, progress, supervise


def _records(spark, rows):
    """rows: (topic, partition, offset, seconds)"""
    return spark.createDataFrame([(None, bytearray(b"x"), t, p, o, None if s is None else dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s), 0)
                                  for t, p, o, s in rows], ENVELOPE)


def test_progress_is_recorded_after_each_batch(spark, tmp_dir):
    path, stored = os.path.join(tmp_dir, "p"), []
    assert progress.committed(spark, path).count() == 0
    high = spark.createDataFrame([("t", 0, 30), ("t", 1, 9)], "topic string, partition int, high long")
    sink = progress.with_progress(lambda df, n: stored.append(df.count()), path, lambda: high)
    sink(_records(spark, [("t", 0, i, i) for i in range(10)] + [("t", 1, 3, 0), ("t", None, None, 0)]), 0)
    sink(_records(spark, [("t", 0, i, i) for i in range(10, 25)]), 1)
    sink(_records(spark, [("t", 0, i, i) for i in range(10, 25)]), 1)  # replayed
    got = {(r["topic"], r["partition"]): r["committed"] for r in progress.committed(spark, path).collect()}
    assert got == {("t", 0): 25, ("t", 1): 4} and stored == [12, 15, 15]
    trend = {(r["batch_id"], r["partition"]): r for r in progress.lag_trend(progress.progress(spark, path)).collect()}
    assert [(trend[k]["lag"], trend[k]["lag_change"]) for k in ((0, 0), (1, 0), (0, 1))] == [(20, None), (5, -15), (5, None)]
    assert trend[1, 0]["batches_left"] == pytest.approx(1 / 3)
    # the lag report takes the same table
    lag = off.consumer_lag(off.partition_offsets(_records(spark, [("t", 0, 29, 0), ("t", 1, 8, 0), ("u", 0, 4, 0)])), progress.committed(spark, path))
    assert {(r["topic"], r["partition"]): r["lag"] for r in lag.collect()} == {("t", 0): 5, ("t", 1): 5, ("u", 0): 5}


def test_a_failed_batch_commits_nothing(spark, tmp_dir):
    def broken(df, n):
        raise RuntimeError("disk")

    with pytest.raises(RuntimeError):
        progress.with_progress(broken, os.path.join(tmp_dir, "p"))(_records(spark, [("t", 0, 1, 0)]), 0)
    assert progress.progress(spark, os.path.join(tmp_dir, "p")).count() == 0


def test_rates_of_a_stream_equal_those_of_a_batch(spark, tmp_dir):
    rows = [("ab"[i % 2], 0, i, i * 7) for i in range(100)] + [("a", 0, 1000, None)]
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    _records(spark, rows).write.parquet(src)
    want = {tuple(r) for r in progress.rate_by_window(_records(spark, rows)).collect()}
    assert sum(r[2] for r in want) == 100 and all(r[3] == round(r[2] / 60, 6) for r in want)
    stream = progress.rate_by_window(spark.readStream.schema(ENVELOPE).parquet(src), late="1 minute")
    q = (stream.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("append").parquet(out))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(out).select("topic", "window_start", "records", "per_second").collect()} == want


def test_monthly_logins_from_daily_states(spark):
    """Days may be states of their own, computed twice, in any order."""
    days = [dt.date(2026, 1, 30), dt.date(2026, 1, 31), dt.date(2026, 2, 1)]
    rows = [(d, f"1.1.1.{i % 3}", str(login)) for d in days for i, login in enumerate(
        [11000001, 11000002, 40000, 0, 7, "007", "+7", "7 ", "bob", "", "9" * 30, 9007199254740993, -4])]
    rows += [(days[0], "1.1.1.0", "bob"), (days[1], "1.1.1.0", "eve"), (days[1], "1.1.1.1", "11000001")]
    frames = [spark.createDataFrame([r for r in rows if r[0] == d], "log_date date, ip string, login string") for d in days]
    state = ds.day_state(frames[2]).unionByName(ds.day_state(frames[0])).unionByName(ds.day_state(frames[1])).unionByName(ds.day_state(frames[0]))
    want = {}
    for d, ip, login in rows:
        want.setdefault((d.replace(day=1), ip), set()).add(login)
    assert {(r["month"], r["ip"]): r["n_logins"] for r in ds.logins_by_month(state).collect()} == {k: len(v) for k, v in want.items()}
    assert ds.logins_by_month(ds.day_state(frames[0].where("false"))).count() == 0


def _landing(tmp_dir, n=6):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing, exist_ok=True)
    for i in range(n):
        with open(os.path.join(landing, f"trading_2026031{i}.log"), "w") as fh:
            fh.write(f"Q\t4\t3\t00:00:0{i}.000\t5.6.7.8\t'{i}': login (Terminal build 1, cid: c{i}, point: P, ping: 1 ms)\n")
    return landing


def test_a_source_that_fails_twice_loses_nothing(spark, tmp_dir):
    base, tries = os.path.join(tmp_dir, "s"), []
    real = ingest.access_log_sink(base + "-raw", base + "-rej")

    def sink(df, n):
        tries.append(n)
        if len(tries) in (1, 3):
            raise OSError("store is away")
        real(df, n)
        if len(tries) == 4:
            raise OSError("stored, but not committed")

    def start():
        if len(tries) == 0 and not os.path.exists(base + "-landing"):
            os.rename(_landing(tmp_dir), base + "-landing")
            raise OSError("no such topic yet")
        stream = ingest.landing_stream(spark, base + "-landing", max_files_per_trigger=2)
        return ingest.start(stream, sink, base + "-ck")

    out = supervise.supervise(spark, start, retries=2, first_pause=0.01)
    assert out.starts == 5 and len(out.failures) == 4 and not out.stopped
    assert sorted(r["cid"] for r in spark.read.parquet(base + "-raw").collect()) == [f"c{i}" for i in range(6)]


def test_supervision_gives_up_and_passes_on_callers_errors(spark, tmp_dir):
    def away():
        raise OSError("away")

    with pytest.raises(OSError):
        supervise.supervise(spark, away, retries=2, first_pause=0.01)

    def wrong():
        raise ValueError("wrong path")

    with pytest.raises(ValueError):
        supervise.supervise(spark, wrong, first_pause=100)


def test_a_stop_marker_ends_a_running_query(spark, tmp_dir):
    base, marker = os.path.join(tmp_dir, "m"), os.path.join(tmp_dir, "stop")
    landing = _landing(tmp_dir)
    real = ingest.access_log_sink(base + "-raw", base + "-rej")

    def sink(df, n):
        real(df, n)
        open(marker, "w").close()

    out = supervise.supervise(spark, lambda: ingest.start(ingest.landing_stream(spark, landing, 1), sink, base + "-ck", "1 second"),
                              stop_marker=marker)
    assert out.stopped and out.starts == 1
    done = spark.read.parquet(base + "-raw").count()
    assert 1 <= done <= 6
    os.remove(marker)
    ingest.start(ingest.landing_stream(spark, landing), real, base + "-ck").awaitTermination()
    assert spark.read.parquet(base + "-raw").count() == 6
    open(marker, "w").close()
    assert supervise.supervise(spark, None, stop_marker=marker).starts == 0
