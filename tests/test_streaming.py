"""Streaming ingest: stream = batch, restart reads new files only, replay
of a batch id adds no rows, day close over the stored tables."""

import os

from pyspark.sql import functions as F

from loglane.operators import access_log as al
from loglane.plans import eod_job
from loglane.plans.queries import day_lines
from loglane.streaming import ingest


def _land(spark, lines, landing, date_filter):
    (lines.where(F.col("file_name").isin(date_filter)).select("file_name", "line")
     .write.mode("append").partitionBy("file_name").text(landing))


def test_stream_restart_replay_and_close(spark, tmp_dir):
    lines = day_lines(spark, "/root/testdata/sf0.001")
    files = sorted(r[0] for r in lines.select("file_name").distinct().collect())
    landing, raw, rej, ck = (os.path.join(tmp_dir, x) for x in ("landing", "raw", "rej", "ck"))
    _land(spark, lines, landing, files[:2])
    ingest.ingest_access_log(spark, landing, raw, rej, ck).awaitTermination()
    n1 = spark.read.parquet(raw).count()
    batch = al.parse_strict(al.cid_filter(lines.where(F.col("file_name").isin(files[:2]))))
    valid, _ = al.split_by_length(batch)
    assert n1 == valid.count()

    # restart with the same checkpoint: only the new file is read
    _land(spark, lines, landing, files[2:3])
    ingest.ingest_access_log(spark, landing, raw, rej, ck).awaitTermination()
    stored = spark.read.parquet(raw)
    per_batch = {r["batch_id"]: r["count"] for r in stored.groupBy("batch_id").count().collect()}
    assert sorted(per_batch) == [0, 1]
    assert stored.where("batch_id = 1").select("file_name").distinct().first()[0] == files[2]
    n_before = stored.count()

    # replaying batch 0 (same id, same input) replaces its output
    sink = ingest.access_log_sink(raw, rej)
    sink(lines.where(F.col("file_name").isin(files[:2])).select("file_name", "line"), 0)
    assert spark.read.parquet(raw).count() == n_before

    # day close on stored rows; a second run changes nothing
    day = files[0][len("trading_"):len("trading_") + 8]
    landing_file = [os.path.join(landing, f"file_name={files[0]}", x)
                    for x in os.listdir(os.path.join(landing, f"file_name={files[0]}")) if x.endswith(".txt")][0]
    table = os.path.join(tmp_dir, "table")
    s1 = eod_job.close_day(spark, day, landing_file, raw, table).first()
    s2 = eod_job.close_day(spark, day, landing_file, raw, table).first()
    t = spark.read.parquet(table)
    assert s1["trade_count"] + s1["lilo_count"] == t.count() > 0
    assert (s2["trade_count"], s2["lilo_count"]) == (0, 0)
    assert t.where(F.col("flag") == "pending").count() == 0


def test_missing_day_file_fails(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        eod_job.close_day(spark, "20260318", os.path.join(tmp_dir, "trading_20260318.log"),
                          os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "t"))


def test_counters_and_null_values(spark, tmp_dir):
    from loglane.streaming.ingest import MISSING_VALUE
    good = ("XA\t4\t3\t00:00:00.028\t1.2.3.4\t'7': login (Client build 1, cid: abc, point: P, "
            "ping: 1 ms, geo: IN)")
    rows = [("trading_20260318.log", good), ("trading_20260318.log", "XA\t0\t2\tt\tMonitor\tx"),
            ("trading_20260318.log", None)]
    batch = spark.createDataFrame(rows, "file_name string, line string")
    raw, rej, cnt = (os.path.join(tmp_dir, x) for x in ("raw", "rej", "cnt"))
    ingest.access_log_sink(raw, rej, counters_path=cnt)(batch, 7)
    assert spark.read.parquet(raw).count() == 1
    r = spark.read.parquet(rej).collect()
    assert [x["reason"] for x in r] == [MISSING_VALUE]
    c = spark.read.parquet(cnt).first()
    assert (c["batch_id"], c["lines"], c["sent"], c["skipped"], c["inserted"], c["rejected"]) == (7, 3, 1, 2, 1, 1)


def test_lag_guard_and_clock(spark):
    import datetime as dt
    from loglane.operators import offsets as off
    wm = spark.createDataFrame([("a", 0, 0, 5)], "topic string, partition int, low bigint, high bigint")
    cm = spark.createDataFrame([], "topic string, partition int, committed bigint")
    assert off.lag_for_topic(wm, cm, "missing").count() == 0
    assert off.lag_for_topic(wm, cm, "a").first()["lag"] == 5
    assert eod_job.run_clock(6) > dt.datetime.now() + dt.timedelta(hours=5, minutes=59)


def test_topic_envelope_stream(spark, tmp_dir):
    """Records in the topic envelope shape, streamed from Parquet files (a
    stand-in for the Kafka source, which is not installed here)."""
    from loglane.schemas import ENVELOPE
    from loglane.sources.files import lines_to_envelope

    lines = day_lines(spark, "/root/testdata/sf0.001")
    day = sorted(r[0] for r in lines.select("file_name").distinct().collect())[0]
    one = al.cid_filter(lines.where(F.col("file_name") == day))
    env = lines_to_envelope(one.select("file_name", "line"), topic="trading-access-logs",
                            key=al.login_key("line"))
    env = env.withColumn("partition", F.lit(0)).withColumn("offset", F.col("timestamp").cast("long") * 0)
    bad = spark.createDataFrame([(None, bytearray(b"\xff\xfe"), "trading-access-logs", 1, 5, None, 0)], ENVELOPE)
    src = os.path.join(tmp_dir, "topic")
    env.unionByName(bad.withColumn("timestamp", F.current_timestamp())).write.parquet(src)
    raw, rej, ck = (os.path.join(tmp_dir, x) for x in ("raw", "rej", "ck"))
    stream = spark.readStream.schema(ENVELOPE).parquet(src)
    ingest.ingest_topic_access_log(stream, raw, rej, ck, day[len("trading_"):len("trading_") + 8]).awaitTermination()
    valid, _ = al.split_by_length(al.parse_strict(one))
    got = spark.read.parquet(raw)
    assert got.count() == valid.count() > 0
    assert {r["file_name"] for r in got.select("file_name").distinct().collect()} == {day}
    r = spark.read.parquet(rej).where(F.col("offset") == 5).first()
    assert (r["partition"], r["reason"]) == (1, ingest.MISSING_VALUE)


def test_create_tables_if_absent(spark, tmp_dir):
    from loglane.plans import tables
    from loglane.schemas import ACCESS_LOG_COLUMNS, APP_LOG_COLUMNS
    a = tables.create_access_log(spark, "t_access_log", os.path.join(tmp_dir, "access_log"))
    tables.create_access_log(spark, "t_access_log", os.path.join(tmp_dir, "access_log"))  # no error twice
    b = tables.create_app_logs(spark, "t_app_logs", os.path.join(tmp_dir, "app_logs"))
    assert set(ACCESS_LOG_COLUMNS) <= set(spark.table(a).columns)
    assert set(APP_LOG_COLUMNS) <= set(spark.table(b).columns)
    assert spark.table(a).count() == 0


def test_close_day_with_utf16_day_file(spark, tmp_dir):
    import datetime as dt
    import io

    day = os.path.join(tmp_dir, "trading_20260318.log")
    with io.open(day, "w", encoding="utf-16") as fh:
        fh.write("XA\t0\t6\t00:00:00.1\t1.2.3.4\t'7': order placed for execution for '7' [#1 buy 1 X at 2]\n")
        fh.write("XA\t0\t2\t00:00:00.2\tMonitor\tconnections: 5\n")
    d = dt.date(2026, 3, 18)
    rows = [("trading_20260318.log", d, "00:00:01.000", ip, "7", "c", "Client", "point: P", "pending", "no", 0)
            for ip in ("1.2.3.4", "9.9.9.9")]
    raw = os.path.join(tmp_dir, "raw")
    spark.createDataFrame(rows, "file_name string, log_date date, log_time string, ip string, login string, "
                                "cid string, device string, server string, flag string, investor string, "
                                "batch_id int").write.partitionBy("log_date", "batch_id").parquet(raw)
    s = eod_job.close_day(spark, "20260318", day, raw, os.path.join(tmp_dir, "t")).first()
    assert (s["trade_count"], s["lilo_count"]) == (1, 1)
    assert (s["lines_scanned"], s["trade_ips"]) == (2, 1)
    assert "2 lines, 1 trade IPs" in eod_job.summary_message(s)
    # Where the address set is too large to broadcast, the same close runs as a sort-merge join.
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        s2 = eod_job.close_day(spark, "20260318", day, raw, os.path.join(tmp_dir, "t2")).first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (s2["trade_count"], s2["lilo_count"]) == (1, 1)
    got = {r["ip"]: r["flag"] for r in spark.read.parquet(os.path.join(tmp_dir, "t")).collect()}
    assert got == {"1.2.3.4": "trade", "9.9.9.9": "lilo"}


def test_cli_close_day_and_ingest(spark, tmp_dir, capsys):
    from loglane import cli

    lines = day_lines(spark, "/root/testdata/sf0.001")
    day = sorted(r[0] for r in lines.select("file_name").distinct().collect())[0]
    logs = os.path.join(tmp_dir, "logs")
    os.makedirs(logs)
    with open(os.path.join(logs, day), "w") as fh:
        for r in lines.where(F.col("file_name") == day).orderBy("line_no").collect():
            fh.write(r["line"] + "\n")
    raw, rej, ck, table = (os.path.join(tmp_dir, x) for x in ("raw", "rej", "ck", "table"))
    assert cli.main(["ingest-access", "--landing", logs, "--raw", raw, "--rejects", rej, "--checkpoint", ck]) == 0
    date = day[len("trading_"):len("trading_") + 8]
    assert cli.main(["close-day", "--date", date, "--logs", logs, "--raw", raw, "--table", table]) == 0
    out = capsys.readouterr().out
    assert "Closed " in out and "trade IPs" in out and "Done in" in out
    assert cli.main(["close-day", "--date", "20000101", "--logs", logs, "--raw", raw, "--table", table]) == 1


def test_cli_lag_report(spark, tmp_dir, capsys):
    from loglane import cli
    recs = spark.createDataFrame([("t", p, o) for p in range(3) for o in range(10 + p)],
                                 "topic string, partition int, offset bigint")
    path = os.path.join(tmp_dir, "recs")
    recs.write.parquet(path)
    ck = os.path.join(tmp_dir, "ck")
    os.makedirs(os.path.join(ck, "offsets"))
    os.makedirs(os.path.join(ck, "commits"))
    with open(os.path.join(ck, "offsets", "0"), "w") as fh:
        fh.write('v1\n{"batchWatermarkMs":0}\n{"t":{"0":10,"1":5}}')
    with open(os.path.join(ck, "commits", "0"), "w") as fh:
        fh.write("v1\n{}")
    assert cli.main(["lag-report", "--topic", "t", "--records", path, "--checkpoint", ck]) == 0
    out = capsys.readouterr().out
    assert "partition 0: at 10 of 10, lag 0 [OK]" in out
    assert "partition 1: at 5 of 11, lag 6 [BEHIND by 6]" in out
    assert "partition 2: at 0 of 12, lag 12" in out and "total lag: 18" in out
    assert cli.main(["lag-report", "--topic", "nope", "--records", path, "--checkpoint", ck]) == 0
    assert "no such topic so far" in capsys.readouterr().out


def test_new_checkpoint_over_existing_output_is_refused(spark, tmp_dir):
    import pytest
    lines = day_lines(spark, "/root/testdata/sf0.001")
    files = sorted(r[0] for r in lines.select("file_name").distinct().collect())
    landing = os.path.join(tmp_dir, "landing")
    _land(spark, lines, landing, files[:1])
    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    ingest.ingest_access_log(spark, landing, raw, rej, os.path.join(tmp_dir, "ck1")).awaitTermination()
    # the same checkpoint may resume ...
    ingest.ingest_access_log(spark, landing, raw, rej, os.path.join(tmp_dir, "ck1")).awaitTermination()
    # ... but a fresh one over the same output would restart batch ids at 0
    with pytest.raises(ValueError):
        ingest.ingest_access_log(spark, landing, raw, rej, os.path.join(tmp_dir, "ck2"))


def _writers(spark, path):
    """Numbers of the tasks that wrote the files of a table."""
    names = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()
    return {os.path.basename(r["f"])[:len("part-00000")] for r in names}


def test_an_app_log_batch_is_read_by_several_tasks(spark, tmp_dir):
    landing, run = os.path.join(tmp_dir, "app"), os.path.join(tmp_dir, "run")
    os.makedirs(landing)
    for i in range(12):
        with open(os.path.join(landing, f"app-{i}.log"), "w") as fh:
            fh.write(f"2026-03-10 00:00:0{i % 10}.000 | INFO  | user_id={i} | endpoint=/api/x | method=GET | status=200"
                     " | duration_ms=1 | ip=10.0.0.1\n")
    ingest.ingest_app_log(spark, landing, run + "/raw", run + "/rej", run + "/ck").awaitTermination()
    assert sorted(int(r["user_id"]) for r in spark.read.parquet(run + "/raw").collect()) == list(range(12))
    assert len(_writers(spark, run + "/raw")) > 1


def _day_batch(spark, tmp_dir, encodings):
    landing, run = os.path.join(tmp_dir, "days"), os.path.join(tmp_dir, "run")
    os.makedirs(landing)
    for i in range(12):
        line = f"Q\t4\t3\t00:00:00.000\t5.6.7.8\t'{i}': login (Terminal build 1, cid: c{i}, point: P, ping: 1 ms)\n"
        with open(os.path.join(landing, f"trading_202603{i + 10}.log"), "w", encoding=encodings[i % len(encodings)]) as fh:
            fh.write(line)
    ingest.ingest_access_log(spark, landing, run + "/raw", run + "/rej", run + "/ck").awaitTermination()
    assert sorted(r["cid"] for r in spark.read.parquet(run + "/raw").collect()) == sorted(f"c{i}" for i in range(12))
    return _writers(spark, run + "/raw")


def test_an_access_log_batch_is_read_by_several_tasks(spark, tmp_dir):
    assert len(_day_batch(spark, tmp_dir, ["utf-8"])) > 1


def test_a_batch_of_mixed_encodings_is_read_by_several_tasks(spark, tmp_dir):
    assert len(_day_batch(spark, tmp_dir, ["utf-8", "utf-16"])) > 1


def test_a_task_of_a_mixed_batch_does_not_grow_with_the_batch(spark, tmp_dir):
    """Opening a file counts 4 MB and a task takes 32 MB: eight small files a task, on average."""
    landing, run = os.path.join(tmp_dir, "days"), os.path.join(tmp_dir, "run")
    n = 16 * spark.sparkContext.defaultParallelism
    for i in range(n):
        folder = os.path.join(landing, f"file_name=trading_2026031{i % 3}.log")
        os.makedirs(folder, exist_ok=True)
        encoding = ["utf-8", "utf-16-le", "utf-16-be"][i % 3]
        line = f"Q\t4\t3\t00:00:00.000\t5.6.7.8\t'{i}': login (Terminal build 1, cid: c{i}, point: P, ping: 1 ms)\n"
        with open(os.path.join(folder, f"part-{i}"), "wb") as fh:
            fh.write((b"" if i % 3 == 0 else "\ufeff".encode(encoding)) + line.encode(encoding))
    ingest.ingest_access_log(spark, landing, run + "/raw", run + "/rej", run + "/ck").awaitTermination()
    raw = spark.read.parquet(run + "/raw")
    assert sorted(r["cid"] for r in raw.collect()) == sorted(f"c{i}" for i in range(n))
    task = F.regexp_extract(F.input_file_name(), r"/(part-\d{5})[^/]*$", 1)
    assert raw.groupBy(task.alias("task")).count().agg(F.max("count")).first()[0] < n / 4
