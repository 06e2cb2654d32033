"""Stored-table close: row identity, empty days, hot addresses, SQL visibility."""

import datetime as dt
import os

from pyspark.sql import functions as F

from loglane.operators import access_log as al
from loglane.plans import eod_job, tables
from loglane.streaming import ingest

DAY = "20310705"
FILE = f"trading_{DAY}.log"


def _login(i, ip="1.2.3.4"):
    return f"Q\t4\t3\t00:00:{i % 60:02d}.{i % 1000:03d}\t{ip}\t'{i}': login (Terminal build 1, cid: c{i}, point: P, ping: 1 ms)"


def _lines(spark, lines, name=FILE):
    return spark.createDataFrame([(name, x) for x in lines], "file_name string, line string")


def _day_file(folder, lines):
    path = os.path.join(folder, FILE)
    with open(path, "w") as fh:
        fh.write("".join(x + "\n" for x in lines))
    return path


TRADE = "Q\t0\t6\t00:00:01.000\t1.2.3.4\t'7': market buy #1"


def test_two_raw_paths_that_start_at_batch_0(spark, tmp_dir):
    raws = [os.path.join(tmp_dir, f"raw{i}") for i in (0, 1)]
    for i, raw in enumerate(raws):
        sink = ingest.access_log_sink(raw, raw + "-rejects")
        sink(_lines(spark, [_login(10 * i + k, f"1.2.3.{4 + i}") for k in range(4)]), 0)
    day, table = _day_file(tmp_dir, [TRADE]), os.path.join(tmp_dir, "table")
    first = eod_job.close_day(spark, DAY, day, raws[0], table).first()
    assert (first["trade_count"], first["lilo_count"]) == (4, 0)
    both = eod_job.close_day(spark, DAY, day, raws, table).first()
    assert (both["trade_count"], both["lilo_count"]) == (0, 4)
    assert spark.read.parquet(table).count() == 8
    assert eod_job.close_day(spark, DAY, day, raws, table).first()["lilo_count"] == 0
    assert spark.read.parquet(table).count() == 8


def test_empty_day_gives_one_summary_row(spark, tmp_dir):
    day = _day_file(tmp_dir, [TRADE, "other"])
    rows = eod_job.close_day(spark, DAY, day, os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "table")).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2031, 7, 5), 2, 1, 0, 0)]
    assert not os.path.exists(os.path.join(tmp_dir, "table"))


def test_staging_is_removed(spark, tmp_dir):
    from loglane.session import work_path
    from loglane.sources import fs

    before = set(fs.children(spark, work_path(spark, "staging")))
    test_empty_day_gives_one_summary_row(spark, tmp_dir)
    assert set(fs.children(spark, work_path(spark, "staging"))) <= before


def test_undated_and_whole_rejects(spark, tmp_dir):
    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    long = _login(1).replace("Terminal", "Terminal" + "x" * 200)
    ingest.access_log_sink(raw, rej)(_lines(spark, [_login(1), long]).union(_lines(spark, [_login(2)], "today.log")), 3)
    assert spark.read.parquet(raw).count() == 1
    got = {r["reason"]: r["raw"] for r in spark.read.parquet(rej).collect()}
    assert got == {"device longer than 100": long, ingest.UNDATED: _login(2)}
    # a replay of the batch replaces both
    ingest.access_log_sink(raw, rej)(_lines(spark, [_login(5)]), 3)
    assert [r["cid"] for r in spark.read.parquet(raw).collect()] == ["c5"]
    assert not [c for c in os.listdir(rej) if c.startswith("run_id=")] or not any(
        f.endswith(".parquet") for _, _, fs_ in os.walk(rej) for f in fs_)


def test_one_address_with_half_of_the_rows(spark, tmp_dir):
    """No file of the closed day holds more than twice the mean, and each is sorted by address."""
    raw = os.path.join(tmp_dir, "raw")
    n = 8000
    lines = [_login(i, "9.9.9.9" if i % 2 else f"10.0.{i % 97}.{i % 31}") for i in range(n)]
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, lines).repartition(8), 0)
    table = os.path.join(tmp_dir, "table")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        eod_job.close_day(spark, DAY, _day_file(tmp_dir, [TRADE]), raw, table)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    stored = spark.read.parquet(table).withColumn("f", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("f").count().collect()]
    assert sum(sizes) == n and len(sizes) >= 4 and max(sizes) <= 2 * n / len(sizes)
    by_file = {}
    for r in stored.withColumn("i", F.monotonically_increasing_id()).orderBy("i").select("f", "ip").collect():
        by_file.setdefault(r["f"], []).append(r["ip"])
    assert all(v == sorted(v) for v in by_file.values())


def test_closed_day_is_visible_to_sql(spark, tmp_dir):
    table = os.path.join(tmp_dir, "table")
    name = tables.create_access_log(spark, "t_closed", table)
    raw = os.path.join(tmp_dir, "raw")
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(i) for i in range(3)]), 0)
    eod_job.close_day(spark, DAY, _day_file(tmp_dir, [TRADE]), raw, table, table_name=name)
    rows = spark.sql(f"SELECT flag, etl_timestamp, log_date FROM {name}").collect()
    assert [r["flag"] for r in rows] == ["trade"] * 3
    assert all(r["etl_timestamp"] is not None and r["log_date"] == dt.date(2031, 7, 5) for r in rows)


def test_topic_consumer_parses_every_record(spark, tmp_dir):
    from loglane.sources.files import lines_to_envelope

    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    plain = "Q\t4\t3\t00:00:09.000\t5.6.7.8\t'8': logout (Terminal)"
    env = lines_to_envelope(_lines(spark, [_login(1), plain]), topic="t")
    ingest.envelope_access_log_sink(raw, rej, DAY)(env, 0)
    got = {r["login"]: (r["ip"], r["cid"], r["server"]) for r in spark.read.parquet(raw).select(*al.ACCESS_LOG_COLUMNS).collect()}
    assert got == {"1": ("1.2.3.4", "c1", "point: P"), "8": ("5.6.7.8", "unknown", "Unknown")}


def test_order_rejects_have_reasons(spark):
    from loglane.operators.orders import decode_orders

    good = '{"order_id":1,"customer":"c","item":"w","quantity":2}'
    cases = {good: None, good + " x": "not an order message", good + "," + good: "not an order message",
             '{"order_id":1}': "missing or mistyped: customer, item, quantity",
             good.replace(":2", ':"many"'): "missing or mistyped: quantity", "": "not an order message", None: "value is missing"}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "id int, value string")
    got = {r["id"]: r["reason"] for r in decode_orders(df, keep=["id"]).collect()}
    assert got == dict(enumerate(cases.values()))


def test_recorder_flushes_to_a_table(spark, tmp_dir):
    from loglane.streaming.monitor import ProgressRecorder

    rec = ProgressRecorder()
    rec._rows.append(("q", None, 0, 5, 1.0, 2.0, 3, None))
    path = os.path.join(tmp_dir, "progress")
    assert (rec.flush(spark, path), rec.flush(spark, path)) == (1, 0)
    assert spark.read.parquet(path).count() == 1 and rec.to_df(spark).count() == 0


def _closed(spark, tmp_dir, parts, name="c"):
    """A table closed after each part of the logins arrived."""
    raw, table = os.path.join(tmp_dir, f"{name}-raw"), os.path.join(tmp_dir, f"{name}-table")
    day = _day_file(tmp_dir, [TRADE])
    for n, part in enumerate(parts):
        ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, part), n)
        eod_job.close_day(spark, DAY, day, raw, table)
    return raw, table, day


def _files(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(table) for f in names if f.endswith(".parquet")}


def test_a_late_row_writes_its_own_file_only(spark, tmp_dir):
    raw, table, day = _closed(spark, tmp_dir, [[_login(i) for i in range(500)]])
    before = _files(table)
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(900, "8.8.8.8")]), 1)
    s = eod_job.close_day(spark, DAY, day, raw, table).first()
    assert (s["trade_count"], s["lilo_count"]) == (0, 1)
    after = _files(table)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    late = eod_job.closed_rows(spark, table).where("ip = '8.8.8.8'").first()
    assert late["flag"] == "lilo" and late["close"].startswith("000002-")
    assert spark.read.parquet(table).count() == 501


def test_a_late_row_reads_new_batches_only(spark, tmp_dir):
    raw, table, _ = _closed(spark, tmp_dir, [[_login(1)], [_login(2)]])
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(3)]), 7)
    rows = eod_job.pending_rows(spark, raw, table, "2031-07-05")
    assert [os.path.basename(os.path.dirname(f)) for f in rows.inputFiles()] == ["batch_id=7"]


def test_pending_rows_open_no_closed_file(spark, tmp_dir):
    """Also once the day is folded: the data files of closed rows may be unreadable."""
    raw, table, _ = _closed(spark, tmp_dir, [[_login(1)], [_login(2)]])
    eod_job.fold_day(spark, DAY, table)
    for path in _files(table):
        with open(path, "wb") as fh:
            fh.write(b"not parquet")
    assert eod_job.pending_rows(spark, raw, table, "2031-07-05").count() == 0
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(3)]), 2)
    assert [r["login"] for r in eod_job.pending_rows(spark, raw, table, "2031-07-05").collect()] == ["3"]
    assert eod_job.pending_rows(spark, raw + "-none", table, "2031-07-05").count() == 0


def test_failure_between_write_and_publish_keeps_the_day(spark, tmp_dir, monkeypatch):
    from loglane.sources import fs

    import pytest

    raw, table, day = _closed(spark, tmp_dir, [[_login(i) for i in range(5)]])
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(9, "8.8.8.8")]), 1)
    with monkeypatch.context() as m:
        m.setattr(fs, "rename", lambda *a: False)
        for run in (lambda: eod_job.close_day(spark, DAY, day, raw, table), ):
            with pytest.raises(OSError):
                run()
    assert eod_job.closed_rows(spark, table).count() == spark.read.parquet(table).count() == 5
    assert eod_job.close_day(spark, DAY, day, raw, table).first()["lilo_count"] == 1
    with monkeypatch.context() as m:
        m.setattr(fs, "rename", lambda *a: False)
        with pytest.raises(OSError):
            eod_job.fold_day(spark, DAY, table)
    assert eod_job.closed_rows(spark, table).count() == spark.read.parquet(table).count() == 6


def test_flags_stay_when_a_later_day_file_has_more_trades(spark, tmp_dir):
    raw, table, _ = _closed(spark, tmp_dir, [[_login(1, "8.8.8.8")]])
    more = _day_file(tmp_dir, [TRADE, TRADE.replace("1.2.3.4", "8.8.8.8")])
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(2, "8.8.8.8")]), 1)
    eod_job.close_day(spark, DAY, more, raw, table)
    got = {r["login"]: r["flag"] for r in eod_job.closed_rows(spark, table).collect()}
    assert got == {"1": "lilo", "2": "trade"}


def test_folding_a_day(spark, tmp_dir, monkeypatch):
    from loglane.sources import fs

    raw, table, day = _closed(spark, tmp_dir, [[_login(i, f"1.2.3.{i % 7}") for i in range(40)], [_login(50)], [_login(51)]])
    want = sorted(map(str, eod_job.closed_rows(spark, table).drop("close").collect()))
    real = fs.delete
    with monkeypatch.context() as m:  # the old folders stay: as after a failure just after the switch
        m.setattr(fs, "delete", lambda s, p: None if "close=" in p else real(s, p))
        assert eod_job.fold_day(spark, DAY, table) == 3
    assert sorted(map(str, eod_job.closed_rows(spark, table).drop("close").collect())) == want
    ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(60)]), 3)
    assert eod_job.close_day(spark, DAY, day, raw, table).first()["trade_count"] == 1  # removes them, too
    assert spark.read.parquet(table).count() == len(want) + 1
    assert len([c for c in os.listdir(os.path.join(table, "log_date=2031-07-05")) if c.startswith("close=")]) == 2
    assert eod_job.fold_day(spark, DAY, table) == 2 and eod_job.fold_day(spark, DAY, table) == 1
    assert eod_job.closed_rows(spark, table, ["2031-07-05"]).count() == len(want) + 1
    assert eod_job.closed_rows(spark, table, ["2031-07-06"]).count() == 0


def test_folded_table_in_sql(spark, tmp_dir):
    raw, table, day = _closed(spark, tmp_dir, [])[0], os.path.join(tmp_dir, "sql-table"), _day_file(tmp_dir, [TRADE])
    name = tables.create_access_log(spark, "t_folded", table)
    for n in range(3):
        ingest.access_log_sink(raw, raw + "-rej")(_lines(spark, [_login(n)]), n)
        eod_job.close_day(spark, DAY, day, raw, table, table_name=name)
        assert spark.sql(f"SELECT * FROM {name}").count() == n + 1
    assert eod_job.fold_day(spark, DAY, table, table_name=name) == 3
    assert spark.sql(f"SELECT * FROM {name} WHERE flag = 'trade'").count() == 3
