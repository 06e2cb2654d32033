"""Derived tables written once to the shared folder and then scanned.

Rendered log lines stand in for the day files a log server leaves on
storage. Writing them once (instead of recomputing the rendering inside
every query) keeps the operators' plans the same as on real files: a scan
followed by native expressions. The path is keyed by the source tables'
identity and a version of the rendering code, so a changed input or rule
never reuses stale data. Writes go to a unique folder that is renamed into
place, so concurrent or interrupted runs never expose a partial table."""

from __future__ import annotations

import hashlib
import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import work_path
from . import fs

# Bump when the on-disk layout of derived tables changes.
LAYOUT_VERSION = 2

_PKG_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _code_version() -> str:
    """Hash of the package's source: any change to a rendering rule or an
    operator gives derived tables a new path."""
    h = hashlib.sha1(str(LAYOUT_VERSION).encode())
    for root, _, names in sorted(os.walk(_PKG_DIR)):
        for n in sorted(names):
            if n.endswith(".py"):
                with open(os.path.join(root, n), "rb") as fh:
                    h.update(n.encode())
                    h.update(fh.read())
    return h.hexdigest()


def _fingerprint(spark: SparkSession, paths: list[str]) -> str:
    h = hashlib.sha1(_code_version().encode())
    for p in paths:
        h.update(p.encode())
        h.update(fs.signature(spark, p).encode())
    return h.hexdigest()[:16]


def derived_table(spark: SparkSession, name: str, inputs: list[str],
                  build: Callable[[], DataFrame], partition_by: list[str] | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """Read the derived table ``name``; build and write it on first use.
    ``fmt="text"`` writes the single non-partition column as text lines
    (see ``derived_path`` for streaming sources)."""
    final = work_path(spark, "derived", f"{name}-{_fingerprint(spark, inputs)}")
    if not fs.exists(spark, f"{final}/_SUCCESS"):
        tmp = f"{final}.tmp-{uuid.uuid4().hex[:8]}"
        df = build()
        par = spark.sparkContext.defaultParallelism
        if not partition_by:
            # Small inputs come as one file; spread them so scans run in parallel.
            df = df.repartition(max(par, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.format(fmt).save(tmp)
        # Another run may have finished first; then its copy is used.
        if not fs.exists(spark, final):
            fs.rename(spark, tmp, final)
        if not fs.exists(spark, f"{final}/_SUCCESS"):
            raise RuntimeError(f"derived table {final} could not be published")
    return spark.read.format(fmt).load(final)


def derived_path(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                 partition_by: list[str] | None = None, fmt: str = "text") -> str:
    """Like ``derived_table`` but returns the folder (for streaming sources)."""
    derived_table(spark, name, inputs, build, partition_by, fmt)
    return work_path(spark, "derived", f"{name}-{_fingerprint(spark, inputs)}")
