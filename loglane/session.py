"""Session construction and the few settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every query here is written against. They are SQL confs, so a
# caller's own session can take them with ``apply_settings``.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for k, v in SQL_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "loglane") -> SparkSession:
    """Builder for local runs and tests. On a cluster, pass the master from
    spark-submit and leave ``shuffle_partitions`` to AQE."""
    b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SQL_SETTINGS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, staging and landing data.

    A cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only a local run may leave it unset: it gets a scratch folder. Elsewhere
    executors would each write to their own disk, so that is refused."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="loglane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path (URI or local) under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
