"""Command line: ``python -m loglane.cli <command> ...``

Ingest (``--trigger availableNow`` drains and exits, ``"3 seconds"`` runs until stopped):

* ``ingest-access`` / ``ingest-app --landing DIR``: finished files of a folder; with
  ``--follow``, files that still grow (``--new-only``: from their present end).
* ``ingest-topic-access`` / ``ingest-topic-app`` / ``ingest-orders``: records of a topic,
  from ``--bootstrap HOST:PORT --topic T`` (500 records or 3 s a batch) or from
  ``--records DIR``, Parquet records in the envelope shape. ``--once-by offset|value``
  stores a record that comes again once; ``--progress PATH`` records group progress.
* all take ``--raw --rejects --checkpoint``, ``--counters PATH``, and ``--retries N
  --stop-marker FILE``: restart from the checkpoint after failures (a source that is not
  there yet is waited for), end between batches once the marker exists.

Produce: ``produce-access`` / ``produce-app --landing DIR --checkpoint PATH`` send a folder's
lines to ``--bootstrap --topic``, or as Parquet records to ``--out DIR``.

Close: ``close-day --date YYYYMMDD --logs DIR --raw PATH... --table PATH [--table-name T]``
(exits 1 when the day file is missing) and ``fold-day --date --table``.

Export: ``export-day --date --table --url JDBC_URL --into schema.table`` appends a closed day to
a database (needs its driver on the classpath).

Maintain: ``compact-raw --raw PATH [--table PATH] [--target-mb N]`` joins small batch folders.

Report: ``lag-report --records PATH (--checkpoint PATH | --progress PATH) [--topic T]
[--style app]``: lag per partition of one topic or of all, and totals.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

FILES = ("ingest-access", "ingest-app")
TOPICS = ("ingest-topic-access", "ingest-topic-app", "ingest-orders")
PRODUCERS = ("produce-access", "produce-app")


def _today() -> str:
    return _dt.date.today().strftime("%Y%m%d")


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="loglane")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("close-day")
    c.add_argument("--date", default=_today())
    c.add_argument("--logs", required=True, help="folder holding trading_YYYYMMDD.log")
    c.add_argument("--raw", required=True, nargs="+", help="one or more raw paths")
    f = sub.add_parser("fold-day")
    f.add_argument("--date", required=True)
    for p in (c, f):
        p.add_argument("--table", required=True)
        p.add_argument("--table-name", default=None, help="catalog table over that path, created if absent")
    x = sub.add_parser("export-day")
    for name in ("--date", "--table", "--url", "--into"):
        x.add_argument(name, required=True)
    x.add_argument("--user", default=None)
    x.add_argument("--password", default=None)
    x.add_argument("--driver", default=None)
    k = sub.add_parser("compact-raw")
    k.add_argument("--raw", required=True)
    k.add_argument("--table", default=None, help="closed table of these rows")
    k.add_argument("--target-mb", type=int, default=128)
    lg = sub.add_parser("lag-report")
    lg.add_argument("--topic", default=None, help="all topics without it")
    lg.add_argument("--records", default=None, help="Parquet records with topic, partition, offset")
    lg.add_argument("--bootstrap", default=None, help="read the topic itself instead (needs --topic)")
    group = lg.add_mutually_exclusive_group(required=True)
    group.add_argument("--checkpoint", help="of a consumer of a topic source")
    group.add_argument("--progress", help="what a consumer recorded with --progress")
    lg.add_argument("--style", choices=["trading", "app"], default="trading")
    for name in FILES + TOPICS:
        i = sub.add_parser(name)
        for path in ("--raw", "--rejects", "--checkpoint"):
            i.add_argument(path, required=True)
        i.add_argument("--trigger", default="availableNow")
        i.add_argument("--retries", type=int, default=0, help="failures in a row that are survived")
        i.add_argument("--stop-marker", default=None)
        if name != "ingest-orders":
            i.add_argument("--counters", default=None, help="path for one counters row per batch")
        if name in FILES:
            i.add_argument("--landing", required=True)
            i.add_argument("--max-files", type=int, default=None)
            i.add_argument("--new-only", action="store_true", help="only what is written from now on")
            i.add_argument("--archive", default=None, help="folder for files that were read")
            i.add_argument("--follow", action="store_true", help="files that still grow")
        else:
            _topic_source(i)
            i.add_argument("--once-by", choices=["offset", "value"], default=None)
            i.add_argument("--progress", default=None, help="path for committed offsets per batch")
        if name == "ingest-topic-access":
            i.add_argument("--date", default=_today(), help="the day that the records belong to")
    for name in PRODUCERS:
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--bootstrap", default=None)
        p.add_argument("--topic", default=None)
        p.add_argument("--out", default=None, help="folder for records, instead of a topic")
    return ap


def _topic_source(p: argparse.ArgumentParser) -> None:
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--topic", default=None)
    p.add_argument("--records", default=None, help="Parquet records, instead of a topic")


def _records(spark, args):
    """The streaming envelope that the options name."""
    from .schemas import ENVELOPE
    from .sources import kafka

    if args.records:
        stream = spark.readStream.schema(ENVELOPE).parquet(args.records)
        return stream.where(stream.topic == args.topic) if args.topic else stream
    if not (args.bootstrap and args.topic):
        raise SystemExit("name --records, or --bootstrap and --topic")
    return kafka.read_topic_stream(spark, args.bootstrap, args.topic)


def _ingest_files(spark, args):
    from .sources.tail import tail_stream
    from .streaming import ingest

    access = args.cmd == "ingest-access"
    sink = (ingest.access_log_sink if access else ingest.app_log_sink)(args.raw, args.rejects, counters_path=args.counters)
    now_ms = int(_dt.datetime.now().timestamp() * 1000) if args.new_only else None

    def start():
        ingest.guard_fresh_checkpoint(spark, args.checkpoint, args.raw, args.rejects)
        if args.follow:
            return ingest.start(tail_stream(spark, args.landing, "latest" if args.new_only else "earliest"), sink,
                                args.checkpoint, args.trigger)
        return ingest.start_landing(spark, args.landing, sink, args.checkpoint, args.trigger, args.max_files, now_ms, args.archive)
    return start


def _ingest_topic(spark, args):
    from .streaming import ingest, progress
    from .streaming.state import once_per_record

    if args.cmd == "ingest-topic-access":
        sink = ingest.envelope_access_log_sink(args.raw, args.rejects, args.date, counters_path=args.counters)
    elif args.cmd == "ingest-topic-app":
        sink = ingest.envelope_app_log_sink(args.raw, args.rejects, args.counters)
    else:
        sink = ingest.order_sink(args.raw, args.rejects)
    if args.progress:
        sink = progress.with_progress(sink, args.progress)

    def start():
        ingest.guard_fresh_checkpoint(spark, args.checkpoint, args.raw, args.rejects)
        stream = _records(spark, args)
        return ingest.start(once_per_record(stream, args.once_by) if args.once_by else stream, sink, args.checkpoint, args.trigger)
    return start


def _supervised(spark, args, start) -> int:
    from .streaming import ingest
    from .streaming.supervise import supervise

    queries = []

    def remembered():
        queries.append(start())
        return queries[-1]

    out = supervise(spark, remembered, retries=args.retries, stop_marker=args.stop_marker)
    for q in queries:
        for p in ingest.progress_rates(q):
            print(p)
    if out.failures:
        print(f"{len(out.failures)} failure(s), last: {out.failures[-1]}", file=sys.stderr)
    return 0


def _produce(spark, args) -> int:
    from .sources import kafka
    from .sources.files import landing_stream
    from .streaming import produce

    lines = landing_stream(spark, args.landing)
    if args.cmd == "produce-access":
        records, topic, batching = produce.trading_records(lines), produce.TRADING_TOPIC, {"linger_ms": 50, "batch_size": 65536}
    else:
        records, topic, batching = produce.app_records(lines), produce.APP_TOPIC, {}
    if args.out:
        q = (records.writeStream.format("parquet").option("checkpointLocation", args.checkpoint)
             .trigger(availableNow=True).start(args.out))
    elif args.bootstrap:
        q = kafka.write_topic_stream(records, args.bootstrap, args.topic or topic, args.checkpoint, **batching)
    else:
        raise SystemExit("name --out or --bootstrap")
    q.awaitTermination()
    return 0


def _close(spark, args) -> int:
    from .functions.dates import day_file_for
    from .plans import eod_job, tables

    if args.table_name:
        tables.create_access_log(spark, args.table_name, args.table)
    if args.cmd == "fold-day":
        print(f"{eod_job.fold_day(spark, args.date, args.table, args.table_name)} close(s) of {args.date}")
        return 0
    day_file = f"{args.logs.rstrip('/')}/{day_file_for(args.date)}"
    started = eod_job.run_clock()
    try:
        rows = eod_job.close_day(spark, args.date, day_file, args.raw, args.table, args.table_name).collect()
    except FileNotFoundError as e:
        print(str(e), file=sys.stderr)
        return 1
    for r in rows:  # one summary row per closed day
        print(eod_job.summary_message(r))
    print(f"Done in {eod_job.run_clock() - started}")
    return 0


def _lag(spark, args) -> int:
    from .operators import offsets as off
    from .sources import kafka
    from .streaming import progress

    if args.records:
        records = spark.read.parquet(args.records)
    elif args.bootstrap and args.topic:
        records = kafka.read_topic_batch(spark, args.bootstrap, args.topic)
    else:
        raise SystemExit("name --records, or --bootstrap and --topic")
    if args.topic and records.where(records.topic == args.topic).isEmpty():
        print(f"{args.topic}: no such topic so far")
        return 0
    group = off.checkpoint_offsets(spark, args.checkpoint) if args.checkpoint else progress.committed(spark, args.progress)
    marks = off.partition_offsets(records)
    lag = off.lag_for_topic(marks, group, args.topic, args.style) if args.topic else off.consumer_lag(marks, group, args.style)
    sep = "" if args.style == "app" else ","
    shown = None
    for r in lag.orderBy("topic", "partition").collect():  # one row per partition
        if not args.topic and r["topic"] != shown:
            shown = r["topic"]
            print(shown)
        print(f"  partition {r['partition']}: at {r['committed']:{sep}} of {r['high']:{sep}}, "
              f"lag {r['lag']:{sep}} [{r['status']}]")
    total = off.lag_totals(lag).where("topic is null").first()
    print(f"  total lag: {total['total_lag'] if total and total['total_lag'] is not None else 0:{sep}}")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from .session import build_session

    spark = build_session()
    if args.cmd in ("close-day", "fold-day"):
        return _close(spark, args)
    if args.cmd == "lag-report":
        return _lag(spark, args)
    if args.cmd in PRODUCERS:
        return _produce(spark, args)
    if args.cmd == "export-day":
        from .functions.dates import iso_from_compact
        from .plans.eod_job import closed_rows
        from .schemas import ACCESS_LOG_COLUMNS
        from .sources import jdbc

        rows = closed_rows(spark, args.table, [iso_from_compact(args.date)]).select(*ACCESS_LOG_COLUMNS, "etl_timestamp")
        jdbc.jdbc_append(rows, args.url, args.into, user=args.user, password=args.password, driver=args.driver)
        return 0
    if args.cmd == "compact-raw":
        from .plans.compact import compact_raw

        print(f"{compact_raw(spark, args.raw, args.target_mb << 20, args.table)} folder(s) replaced")
        return 0
    return _supervised(spark, args, (_ingest_files if args.cmd in FILES else _ingest_topic)(spark, args))


if __name__ == "__main__":
    sys.exit(main())
