"""The jobs on the command line, end to end over files and Parquet records."""

import os

import pytest
from pyspark.sql import functions as F

from loglane import cli
from loglane.schemas import ENVELOPE

DAY = "20260318"


def _line(i):
    return f"Q\t4\t3\t00:00:{i % 60:02}.000\t5.6.7.{i % 4}\t'{i}': login (Terminal build 1, cid: c{i}, point: P, ping: 1 ms)"


def _paths(tmp_dir, name):
    base = os.path.join(tmp_dir, name)
    return base, ["--raw", base + "-raw", "--rejects", base + "-rej", "--checkpoint", base + "-ck"]


def _envelope(spark, rows, path):
    """rows: (topic, partition, offset, key, value)"""
    df = spark.createDataFrame([(t, p, o, k, v) for t, p, o, k, v in rows], "topic string, partition int, offset long, k string, v string")
    (df.select(F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), "topic", "partition", "offset",
               F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType")).select(*ENVELOPE.names)
     .coalesce(1).write.mode("append").parquet(path))


def test_topic_records_to_closed_table_and_lag(spark, tmp_dir, capsys):
    base, paths = _paths(tmp_dir, "t")
    topic = base + "-topic"
    rows = [("trading", i % 3, i, str(i), _line(i)) for i in range(12)]
    _envelope(spark, rows + rows[:4] + [("other", 0, 0, None, "x")], topic)
    run = ["ingest-topic-access", "--records", topic, "--topic", "trading", "--date", DAY, "--once-by", "offset",
           "--progress", base + "-progress", "--counters", base + "-cnt", *paths]
    assert cli.main(run) == 0
    _envelope(spark, rows[:2] + [("trading", 0, 12, "12", _line(12)), ("trading", 1, 13, "13", _line(13))], topic)
    assert cli.main(run) == 0
    assert spark.read.parquet(base + "-raw").count() == 14
    _envelope(spark, [("trading", 2, 14, "14", _line(14))], topic)
    capsys.readouterr()
    assert cli.main(["lag-report", "--records", topic, "--progress", base + "-progress"]) == 0
    out = capsys.readouterr().out
    assert "other\n  partition 0: at 0 of 1, lag 1 [BEHIND by 1]" in out and "  partition 2: at 12 of 15, lag 3" in out
    assert "total lag: 4" in out
    assert cli.main(["lag-report", "--records", topic, "--progress", base + "-progress", "--topic", "trading"]) == 0
    assert "total lag: 3" in capsys.readouterr().out

    with open(os.path.join(tmp_dir, f"trading_{DAY}.log"), "w") as fh:
        fh.write("Q\t0\t6\t00:00:01.000\t5.6.7.0\t'7': market buy #1\n")
    close = ["--date", DAY, "--table", base + "-table", "--table-name", "t_cli_closed"]
    assert cli.main(["close-day", "--logs", tmp_dir, "--raw", base + "-raw", *close]) == 0
    assert "4 rows set to trade, 10 to lilo" in capsys.readouterr().out
    assert spark.sql("SELECT count_if(flag = 'trade') FROM t_cli_closed").first()[0] == 4
    assert cli.main(["fold-day", *close]) == 0 and "1 close(s)" in capsys.readouterr().out
    from loglane.sources import jdbc

    sent = []
    with pytest.MonkeyPatch.context() as m:  # no driver here: what would be appended
        m.setattr(jdbc, "jdbc_append", lambda df, url, into, **kw: sent.append((df.count(), df.columns[-1], url, into, kw["user"])))
        assert cli.main(["export-day", "--date", DAY, "--table", base + "-table", "--url", "jdbc:x", "--into", "s.t", "--user", "u"]) == 0
    assert sent == [(14, "etl_timestamp", "jdbc:x", "s.t", "u")]
    assert cli.main(["compact-raw", "--raw", base + "-raw", "--table", base + "-table"]) == 0
    assert "0 folder(s)" in capsys.readouterr().out  # the newest batch stays
    with pytest.raises(SystemExit):
        cli.main(["lag-report", "--checkpoint", base + "-ck"])


def test_app_and_order_records(spark, tmp_dir):
    base, paths = _paths(tmp_dir, "a")
    _envelope(spark, [("app", 0, 0, None, "2026-01-01 00:00:00 | INFO | user_id=1 | status=200"), ("app", 0, 1, None, "broken")], base + "-t")
    assert cli.main(["ingest-topic-app", "--records", base + "-t", *paths]) == 0
    assert (spark.read.parquet(base + "-raw").count(), spark.read.parquet(base + "-rej").count()) == (1, 1)
    base, paths = _paths(tmp_dir, "o")
    good = '{"order_id":1,"customer":"c","item":"w","quantity":2}'
    _envelope(spark, [("orders", 0, 0, "1", good), ("orders", 0, 1, "2", "{")], base + "-t")
    assert cli.main(["ingest-orders", "--records", base + "-t", *paths]) == 0
    assert spark.read.parquet(base + "-raw").first()["order_id"] == 1 and spark.read.parquet(base + "-rej").count() == 1


def test_following_growing_files_and_producing(spark, tmp_dir):
    base, paths = _paths(tmp_dir, "f")
    logs = base + "-logs"
    run = ["ingest-access", "--landing", logs, "--follow", *paths]
    assert cli.main(run) == 0  # nothing there yet
    os.makedirs(logs)
    for text in (_line(1) + "\n" + _line(2)[:20], _line(2)[20:] + "\nno login\n"):
        with open(os.path.join(logs, f"trading_{DAY}.log"), "a") as fh:
            fh.write(text)
        assert cli.main(run) == 0
    assert sorted(r["cid"] for r in spark.read.parquet(base + "-raw").collect()) == ["c1", "c2"]
    assert cli.main(["produce-access", "--landing", logs, "--checkpoint", base + "-pck", "--out", base + "-out"]) == 0
    assert sorted(r["key"] for r in spark.read.parquet(base + "-out").collect()) == ["1", "2"]
    assert cli.main(["produce-app", "--landing", logs, "--checkpoint", base + "-ack", "--out", base + "-app"]) == 0
    assert spark.read.parquet(base + "-app").count() == 3


def test_a_stop_marker_and_missing_options(spark, tmp_dir):
    base, paths = _paths(tmp_dir, "s")
    marker = base + "-stop"
    open(marker, "w").close()
    assert cli.main(["ingest-app", "--landing", base + "-logs", "--trigger", "1 second", "--stop-marker", marker, *paths]) == 0
    with pytest.raises(SystemExit):
        cli.main(["ingest-topic-app", *paths])
    with pytest.raises(SystemExit):
        cli.main(["produce-app", "--landing", base + "-logs", "--checkpoint", base + "-x"])
