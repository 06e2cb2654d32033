"""One-pass batch loads, independent stream readers, rate-limited triggers."""

import os

from pyspark.sql import functions as F

from loglane.operators import access_log as al
from loglane.operators import app_log as ap
from loglane.plans import batch_load
from loglane.plans.queries import REGISTRY, app_lines, day_lines
from loglane.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_one_pass_app_log_load(spark, tmp_dir):
    out = os.path.join(tmp_dir, "app")
    batch_load.load_app_log(app_lines(spark, SF), out, "l1")
    batch_load.load_app_log(app_lines(spark, SF), out, "l1")  # re-run replaces
    valid = batch_load.read_outcome(spark, out).select(*ap.FIELDS)
    want = REGISTRY["app_log_typed"](spark, SF).select(*ap.FIELDS)
    assert valid.exceptAll(want).count() == 0 and want.exceptAll(valid).count() == 0
    rej = batch_load.read_outcome(spark, out, "rejected")
    assert rej.count() == REGISTRY["app_log_rejects"](spark, SF).count()


def test_one_pass_access_log_load(spark, tmp_dir):
    out = os.path.join(tmp_dir, "acc")
    batch_load.load_access_log(day_lines(spark, SF), out, "l1")
    valid = batch_load.read_outcome(spark, out).select(*al.ACCESS_LOG_COLUMNS)
    want = REGISTRY["access_log_parse_strict"](spark, SF)
    want_valid, want_rej = al.split_by_length(want)
    assert valid.exceptAll(want_valid).count() == 0 and valid.count() == want_valid.count()
    assert batch_load.read_outcome(spark, out, "rejected").count() == want_rej.count()


def _land(spark, tmp_dir, n_files):
    lines = day_lines(spark, SF)
    files = sorted(r[0] for r in lines.select("file_name").distinct().collect())[:n_files]
    landing = os.path.join(tmp_dir, "landing")
    (lines.where(F.col("file_name").isin(files)).select("file_name", "line")
     .write.partitionBy("file_name").text(landing))
    return landing, files


def test_independent_readers(spark, tmp_dir):
    landing, files = _land(spark, tmp_dir, 2)
    counts = []
    for reader in ("a", "b"):
        base = os.path.join(tmp_dir, reader)
        ingest.ingest_access_log(spark, landing, f"{base}/raw", f"{base}/rej", f"{base}/ck").awaitTermination()
        counts.append(spark.read.parquet(f"{base}/raw").count())
    assert counts[0] == counts[1] > 0


def test_rate_limited_trigger(spark, tmp_dir):
    landing, files = _land(spark, tmp_dir, 3)
    n_parts = sum(len([x for x in os.listdir(os.path.join(landing, d)) if x.endswith(".txt")])
                  for d in os.listdir(landing) if d.startswith("file_name="))
    base = os.path.join(tmp_dir, "r")
    q = ingest.ingest_access_log(spark, landing, f"{base}/raw", f"{base}/rej", f"{base}/ck",
                                 trigger="1 second", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    batches = spark.read.parquet(f"{base}/raw").select("batch_id").distinct().count()
    rates = ingest.progress_rates(q)
    assert batches <= n_parts and sum(r["numInputRows"] for r in rates) > 0
    assert max(r["batchId"] for r in rates) + 1 >= n_parts


def test_landing_stream_new_files_only(spark, tmp_dir):
    import time

    from loglane.sources.files import landing_stream

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "trading_20260317.log"), "w") as fh:
        fh.write("old line\n")
    time.sleep(1.2)
    start_ms = int(time.time() * 1000)
    time.sleep(0.2)
    with open(os.path.join(landing, "trading_20260318.log"), "w") as fh:
        fh.write("new line\n")
    q = (landing_stream(spark, landing, newer_than_ms=start_ms).writeStream.format("memory")
         .queryName("new_only").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = [(r["file_name"], r["line"]) for r in spark.table("new_only").collect()]
    assert got == [("trading_20260318.log", "new line")]


def test_topic_ingest_rejects_bad_run_date(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        ingest.envelope_access_log_sink(os.path.join(tmp_dir, "r"), os.path.join(tmp_dir, "j"), "")


def test_counters_come_from_the_scan_that_writes(spark, tmp_dir):
    """One scan of the batch's lines, also where a batch stores nothing."""
    lines = day_lines(spark, SF).select("file_name", "line")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    raw, cnt = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "cnt")
    sink = ingest.access_log_sink(raw, raw + "-rej", counters_path=cnt)
    sink(lines.mapInArrow(counted, lines.schema), 0)
    n = lines.count()
    assert reads.value == n
    sink(lines.where("false"), 1)
    sink(lines.where("not contains(line, 'cid:')"), 2)
    got = {r["batch_id"]: r for r in spark.read.parquet(cnt).collect()}
    sent = al.cid_filter(lines).count()
    assert (got[0]["lines"], got[0]["sent"], got[0]["skipped"]) == (n, sent, n - sent)
    assert got[0]["inserted"] + got[0]["rejected"] == sent
    assert (got[1]["lines"], got[1]["inserted"]) == (0, 0) and got[2]["lines"] == got[2]["skipped"] == n - sent


def test_a_batch_touches_its_own_days_only(spark, tmp_dir, monkeypatch):
    from loglane.sources import fs

    lines = day_lines(spark, SF).select("file_name", "line")
    names = sorted(r[0] for r in lines.select("file_name").distinct().collect())
    raw = os.path.join(tmp_dir, "raw")
    sink = ingest.access_log_sink(raw, raw + "-rej")
    sink(lines, 0)
    asked = []
    real = fs.exists
    monkeypatch.setattr(fs, "exists", lambda s, p: asked.append(p) or real(s, p))
    sink(lines.where(F.col("file_name") == names[0]), 1)
    assert len({p for p in asked if "log_date=" in p}) <= 2
    # a replay whose input moved to another day leaves nothing behind
    sink(lines.where(F.col("file_name") == names[1]), 1)
    got = {r[0] for r in spark.read.parquet(raw).where("batch_id = 1").select("file_name").distinct().collect()}
    assert got == {names[1]}


def test_progress_recorder(spark, tmp_dir):
    import time

    from loglane.streaming.monitor import record_progress
    landing, files = _land(spark, tmp_dir, 2)
    rec = record_progress(spark)
    try:
        base = os.path.join(tmp_dir, "m")
        ingest.ingest_access_log(spark, landing, f"{base}/raw", f"{base}/rej", f"{base}/ck").awaitTermination()
        deadline = time.time() + 15  # listener events are delivered asynchronously
        while time.time() < deadline and rec.to_df(spark).count() == 0:
            time.sleep(0.2)
        df = rec.to_df(spark)
        assert df.count() >= 1 and df.agg({"num_input_rows": "sum"}).first()[0] > 0
    finally:
        spark.streams.removeListener(rec)
