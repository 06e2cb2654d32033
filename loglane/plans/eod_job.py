"""Day close over stored tables: appended, all or nothing, safe to re-run.

Layout:
* ``raw``: streaming appends, partitioned by ``log_date``/``run_id``/``batch_id``,
  never rewritten by this job; several raw paths may feed one table;
* ``table``: the flagged access_log, ``log_date=<day>/close=<n>-<id>/``. Each close
  carries a list of its raw batches (``_batches``, which readers pass over), so
  finding what is pending opens no data file of a closed row.

A flag that was set never changes, so a close has no reason to touch rows of an
earlier one. It reads only the raw batches of the day that the table does
not have yet, flags them against the trade IPs of the day file, writes them once
to a staging folder beside the data and publishes them by renaming that one
folder. One late row costs one small file. A failure before the rename leaves the
day as it was, and the next run starts over; a second run finds nothing to do.

``fold_day`` puts the closes of a day into one, sorted by address. Its folder
stands for all with a smaller number: one rename switches the day, and
the old folders are removed afterwards. ``closed_rows`` reads by that rule, at any
moment; SQL tables and plain folder reads see both for the time between.

On stores whose rename is a copy, give a catalog table: its partitions are added
after the files are in place, and readers of the table see whole closes only.
Close one day from one job at a time.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.dates import iso_from_compact
from ..operators import eod
from ..schemas import ACCESS_LOG
from ..session import work_path
from ..sources import fs
from ..sources.files import read_day_file
from .compact import live_batches

STORED = StructType([*ACCESS_LOG.fields, StructField("run_id", StringType()), StructField("batch_id", LongType()),
                     StructField("etl_timestamp", TimestampType())])
IDENTITY = ["run_id", "batch_id"]
FOLDED = "-fold"
BATCHES = "_batches"
_CLOSE = re.compile(r"close=(\d+)-")


def _number(folder: str) -> int:
    m = _CLOSE.match(folder)
    return int(m[1]) if m else 0


def _closes(spark: SparkSession, table_path: str, log_date: str) -> tuple[list[str], list[str]]:
    """Close folders of a day that count, and those that a fold replaced."""
    day = f"{table_path.rstrip('/')}/log_date={log_date}"
    found = sorted((c for c in fs.children(spark, day) if c.startswith("close=")), key=lambda c: (_number(c), c))
    folds = [i for i, c in enumerate(found) if c.endswith(FOLDED)]
    first = folds[-1] if folds else 0
    return [f"{day}/{c}" for c in found[first:]], [f"{day}/{c}" for c in found[:first]]


def _rows(spark: SparkSession, base: str, folders: list[str]) -> DataFrame:
    """Rows of some partition folders of a table; none without folders."""
    if not folders:
        return spark.createDataFrame([], StructType([*STORED.fields, StructField("close", StringType())]))
    schema = StructType([*STORED.fields, StructField("close", StringType())])
    df = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return df.withColumn("run_id", F.coalesce("run_id", F.lit("")))


def closed_rows(spark: SparkSession, table_path: str, log_dates: list[str] | None = None) -> DataFrame:
    """Rows of the closed table with ``close`` (which close set their flag); of
    some days (ISO text) or all. Only the folders of those days are listed."""
    days = log_dates if log_dates is not None else sorted(
        c.removeprefix("log_date=") for c in fs.children(spark, table_path) if c.startswith("log_date="))
    return _rows(spark, table_path, [f for d in days for f in _closes(spark, table_path, d)[0]])


def new_batches(spark: SparkSession, raw_path: str, log_date: str, have: set[tuple[str, int]]) -> dict[str, set[tuple[str, int]]]:
    """Batch folders of a day under one raw path that hold batches not among
    ``have``, and which batches they hold."""
    day = f"{raw_path.rstrip('/')}/log_date={log_date}"
    out = {}
    for c in fs.children(spark, day):
        if c.startswith("batch_id="):  # a raw path written without run ids
            out[f"{day}/{c}"] = {("", int(c.removeprefix("batch_id=")))}
    out |= {b.folder: {(b.run, i) for i in b.ids} for b in live_batches(spark, raw_path, log_date)[0]}
    return {f: ids for f, ids in out.items() if not ids <= have}


def closed_batches(spark: SparkSession, folders: list[str]) -> set[tuple[str, int]]:
    """(run, batch) of closes, from their lists; of a close without a list from its
    two dictionary-coded columns."""
    have, bare = set(), []
    for folder in folders:
        if fs.exists(spark, f"{folder}/{BATCHES}"):
            have |= {(run, n) for run, n in json.loads(fs.read_text(spark, f"{folder}/{BATCHES}"))}
        else:
            bare.append(folder)
    if bare:
        rows = _rows(spark, bare[0].rpartition("/log_date=")[0], bare).select(*IDENTITY).distinct()  # a row per batch
        have |= {tuple(r) for r in rows.collect()}
    return have


def pending_batches(spark: SparkSession, raw_path: str | list[str], table_path: str,
                    log_date: str) -> dict[str, dict[str, set[tuple[str, int]]]]:
    """Batch folders of one day, by raw path, that the table does not have yet, and
    the batches in them."""
    have = closed_batches(spark, _closes(spark, table_path, log_date)[0])
    found = {p: new_batches(spark, p, log_date, have) for p in ([raw_path] if isinstance(raw_path, str) else raw_path)}
    return {p: folders for p, folders in found.items() if folders}


def pending_rows(spark: SparkSession, raw_path: str | list[str], table_path: str, log_date: str) -> DataFrame:
    """Rows of one day whose flag is not set yet. A batch is known by its run and
    its number; batches of other days or closed ones are not read."""
    out = None
    for path, folders in pending_batches(spark, raw_path, table_path, log_date).items():
        rows = _rows(spark, path, list(folders)).select(*STORED.names)
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], STORED)


def _publish(spark: SparkSession, staged: str, table_path: str, log_date: str, name: str) -> str:
    """Make a written folder part of the table by one rename."""
    day = f"{table_path.rstrip('/')}/log_date={log_date}"
    fs.mkdirs(spark, day)
    if not fs.rename(spark, staged, f"{day}/{name}"):
        raise OSError(f"could not publish {day}/{name}")
    return f"{day}/{name}"


def _write_sorted(rows: DataFrame, path: str) -> None:
    """Ranges of (ip, time): a day is written by many tasks, also where one address
    has most rows, and files hold few addresses, sorted (min/max statistics
    then skip files for ip lookups)."""
    (rows.repartitionByRange("ip", "log_time").sortWithinPartitions("ip")
     .drop("log_date").write.mode("overwrite").parquet(path))


def _list_batches(spark: SparkSession, folder: str, batches: set[tuple[str, int]]) -> None:
    fs.write_text(spark, f"{folder}/{BATCHES}", json.dumps(sorted(batches)))


def _set_flags(rows: DataFrame) -> tuple[int, int]:
    """How many rows are trade and lilo (reads the flag column only)."""
    return tuple(rows.agg(F.count_if(F.col("flag") == eod.TRADE), F.count_if(F.col("flag") == eod.LILO)).first())


def close_day(spark: SparkSession, date_compact: str, day_file: str, raw_path: str | list[str],
              table_path: str, table_name: str | None = None) -> DataFrame:
    """Run the day close for ``date_compact`` (YYYYMMDD). Returns one summary
    row (log_date, lines_scanned, trade_ips, trade_count, lilo_count), counting
    the rows changed by this run; a day without new access rows gives zeros.
    ``table_name``: a catalog table over ``table_path`` that learns of the close.

    The day file is scanned once: its distinct trade IPs (with the line
    count) are written to a staging folder, which also cuts lineage. Their
    size is then known, and the planner and AQE choose the join by bytes."""
    if not fs.exists(spark, day_file):
        raise FileNotFoundError(f"day file not found: {day_file}")
    log_date = iso_from_compact(date_compact)
    d = F.to_date(F.lit(log_date))
    run = uuid.uuid4().hex[:8]
    staging = work_path(spark, "staging", f"eod-{date_compact}-{run}")

    found = eod.trade_ip_scan(read_day_file(spark, day_file), log_date=d)
    found.write.mode("overwrite").parquet(f"{staging}/trade_ip_scan")
    scan = spark.read.schema(found.schema).parquet(f"{staging}/trade_ip_scan")
    n_lines, n_ips = scan.agg(F.coalesce(F.sum("lines"), F.lit(0)), F.count_if("usable")).first()
    ips = scan.where(F.col("usable")).select("log_date", "ip")

    trade = lilo = 0
    clean_up(spark, table_path, log_date, table_name)
    pending = pending_batches(spark, raw_path, table_path, log_date)
    if pending:
        rows = pending_rows(spark, raw_path, table_path, log_date)
        here = f"{table_path.rstrip('/')}/_staging/{run}"
        _write_sorted(eod.apply_flags(rows, ips, [log_date]), here)
        after, before = _set_flags(spark.read.schema("flag string").parquet(here)), _set_flags(rows)
        trade, lilo = after[0] - before[0], after[1] - before[1]
        _list_batches(spark, here, {i for folders in pending.values() for ids in folders.values() for i in ids})
        live, old = _closes(spark, table_path, log_date)
        last = max([0, *(_number(f.rpartition("/")[2]) for f in live + old)])
        folder = _publish(spark, here, table_path, log_date, f"close={last + 1:06d}-{run}")
        if table_name:
            from .tables import add_close

            add_close(spark, table_name, log_date, folder)
    fs.delete(spark, staging)
    return spark.range(1).select(d.alias("log_date"), *[F.lit(int(v)).cast("bigint").alias(k) for k, v in (
        ("lines_scanned", n_lines), ("trade_ips", n_ips), ("trade_count", trade), ("lilo_count", lilo))])


def clean_up(spark: SparkSession, table_path: str, log_date: str, table_name: str | None = None) -> int:
    """Remove closes of a day that a fold replaced; how many there were."""
    _, old = _closes(spark, table_path, log_date)
    for folder in old:
        if table_name:
            from .tables import drop_close

            drop_close(spark, table_name, log_date, folder)
        fs.delete(spark, folder)
    return len(old)


def fold_day(spark: SparkSession, date_compact: str, table_path: str, table_name: str | None = None) -> int:
    """Put the closes of a day into one; how many there were. A day of one
    close (or none) is left alone. Flags and rows stay as they are."""
    log_date = iso_from_compact(date_compact)
    clean_up(spark, table_path, log_date, table_name)
    live, _ = _closes(spark, table_path, log_date)
    if len(live) < 2:
        return len(live)
    run = uuid.uuid4().hex[:8]
    here = f"{table_path.rstrip('/')}/_staging/{run}"
    _write_sorted(_rows(spark, table_path, live).select(*STORED.names), here)
    _list_batches(spark, here, closed_batches(spark, live))
    last = _number(live[-1].rpartition("/")[2])
    folder = _publish(spark, here, table_path, log_date, f"close={last + 1:06d}-{run}{FOLDED}")
    if table_name:
        from .tables import add_close

        add_close(spark, table_name, log_date, folder)
    clean_up(spark, table_path, log_date, table_name)
    return len(live)


def run_clock(offset_hours: int = 6):
    """Driver-side run metadata: the wall clock shifted by ``offset_hours``
    (the reference reports local time + 6 h). Never part of query output."""
    import datetime as _dt
    return _dt.datetime.now() + _dt.timedelta(hours=offset_hours)


def summary_message(row) -> str:
    """One-line day-close message."""
    return (f"Closed {row['log_date']}: {row['lines_scanned']:,} lines, {row['trade_ips']:,} trade IPs; "
            f"{row['trade_count']:,} rows set to trade, {row['lilo_count']:,} to lilo")
