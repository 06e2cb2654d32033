"""Compaction of a raw table's many small batch folders.

A 3 s trigger leaves 28,800 batch folders a day. ``compact_raw`` plans by the sizes
that the file listing has: of each day and run, batches under half the target size
are rewritten as one, in files near the target, by a rebalancing shuffle.

The new folder is ``batch_id=-<n>`` (streams number from 0 up) and holds the list of
the batches it stands for (``_merged``, which readers pass over). One rename
publishes it; from then on the listed folders do not count, and they are
removed. ``live_batches`` and ``raw_rows`` read by that rule at any moment; plain
reads of the folder see both for the time between. A failure leaves either the old
folders or both, and the next run clears up.

The newest batch of a run is never touched: a stream that restarts may replay it.
Batches that a day close has taken are compacted apart from pending ones, so what is
pending stays known. Run one compaction of a raw path at a time, and not beside a
close of the same day."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fs
from ..sources.files import listed

TARGET_BYTES = 128 << 20
MERGED = "_merged"
_BATCH = re.compile(r"(?:log_date=([^/]+)/)?run_id=([^/]+)/batch_id=(-?\d+)$")


@dataclass
class Batch:
    """A batch folder; ``ids`` are the stream's batches that it holds."""

    folder: str
    day: str | None
    run: str
    number: int
    ids: tuple[int, ...]

    @property
    def parent(self) -> str:
        return self.folder.rpartition("/")[0]


def _found(spark: SparkSession, raw_path: str, day: str | None) -> list[Batch]:
    base = raw_path.rstrip("/") + (f"/log_date={day}" if day else "")
    out = []
    for run in fs.children(spark, base):
        if not run.startswith("run_id="):
            continue
        for b in fs.children(spark, f"{base}/{run}"):
            m = _BATCH.search(f"{run}/{b}")
            if m:
                folder, n = f"{base}/{run}/{b}", int(m[3])
                ids = tuple(json.loads(fs.read_text(spark, f"{folder}/{MERGED}"))) if n < 0 else (n,)
                out.append(Batch(folder, day, m[2], n, ids))
    return out


def live_batches(spark: SparkSession, raw_path: str, day: str | None = None) -> tuple[list[Batch], list[Batch]]:
    """Batch folders of one day (or of an undated table) that count, and those that
    a compaction replaced. Of two that hold a batch the larger one counts."""
    found = sorted(_found(spark, raw_path, day), key=lambda b: (b.run, -len(b.ids), b.number))
    taken: set[tuple[str, int]] = set()
    live, old = [], []
    for b in found:
        own = {(b.run, i) for i in b.ids}
        (old if own <= taken else live).append(b)
        taken |= own
    return live, old


def days_of(spark: SparkSession, raw_path: str) -> list[str | None]:
    days = sorted(c.removeprefix("log_date=") for c in fs.children(spark, raw_path) if c.startswith("log_date="))
    return days or [None]


def raw_rows(spark: SparkSession, raw_path: str, days: list[str] | None = None) -> DataFrame:
    """Rows of a raw table, each once, also while it is being compacted."""
    folders = [b.folder for d in (days if days is not None else days_of(spark, raw_path)) for b in live_batches(spark, raw_path, d)[0]]
    if not folders:
        raise FileNotFoundError(f"no batches below {raw_path}")
    return spark.read.option("basePath", raw_path).parquet(*folders)


def folder_sizes(spark: SparkSession, raw_path: str) -> dict[str, int]:
    """Bytes per batch folder, by the end of its path; summed by Spark."""
    files = listed(spark, raw_path).where(F.col("path").endswith(".parquet"))
    name = F.regexp_extract("path", r"((?:log_date=[^/]+/)?run_id=[^/]+/batch_id=-?\d+)/[^/]+$", 1)
    rows = files.groupBy(name.alias("batch")).agg(F.sum("length").alias("size")).where("batch != ''").collect()  # a row per batch
    return {r["batch"]: int(r["size"]) for r in rows}


def compact_raw(spark: SparkSession, raw_path: str, target_bytes: int = TARGET_BYTES, table_path: str | None = None) -> int:
    """Compact all days of a raw table; how many folders went. ``table_path``: the
    closed table of access rows, whose batches are compacted apart."""
    raw_path = raw_path.rstrip("/")
    sizes = folder_sizes(spark, raw_path) if fs.exists(spark, raw_path) else {}
    gone = 0
    newest: dict[str, int] = {}
    plan = []
    for day in days_of(spark, raw_path):
        live, old = live_batches(spark, raw_path, day)
        for b in old:
            fs.delete(spark, b.folder)
            gone += 1
        for b in live:
            newest[b.run] = max(newest.get(b.run, -1), *b.ids)
        plan.append((day, live))
    for day, live in plan:
        closed = _closed(spark, table_path, day) if table_path and day else set()
        groups: dict[tuple[str, bool], list[Batch]] = {}
        for b in live:
            size = sizes.get(_BATCH.search(b.folder)[0], 0)
            if max(b.ids) < newest[b.run] and size < target_bytes // 2:
                groups.setdefault((b.run, all((b.run, i) in closed for i in b.ids)), []).append(b)
        for batches in groups.values():
            if len(batches) > 1:
                gone += _merge(spark, raw_path, batches, target_bytes)
    return gone


def _closed(spark: SparkSession, table_path: str, day: str) -> set[tuple[str, int]]:
    from .eod_job import _closes, closed_batches

    return closed_batches(spark, _closes(spark, table_path, day)[0])


def _merge(spark: SparkSession, raw_path: str, batches: list[Batch], target_bytes: int) -> int:
    ids = sorted({i for b in batches for i in b.ids})
    staged = f"{raw_path}/_staging/compact-{uuid.uuid4().hex[:8]}"
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
        rows = spark.read.parquet(*(b.folder for b in batches))  # columns of the files, not of the path
        rows.hint("rebalance").write.parquet(staged)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    fs.write_text(spark, f"{staged}/{MERGED}", json.dumps(ids))
    taken = {b.number for b in batches}
    number = -(max(ids) + 1)  # the next batch to come decides the name: larger than any merged before
    while number in taken or fs.exists(spark, f"{batches[0].parent}/batch_id={number}"):
        number -= 1_000_000_000
    if not fs.rename(spark, staged, f"{batches[0].parent}/batch_id={number}"):
        raise OSError(f"could not publish batch_id={number}")
    for b in batches:
        fs.delete(spark, b.folder)
    return len(batches)
