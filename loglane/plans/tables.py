"""Target tables: create if absent (Parquet), with the layout of the reference's
access paths re-aimed as partitioning (``log_date``) and sorted files (``ip``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import ACCESS_LOG, APP_LOG, ddl


def create_app_logs(spark: SparkSession, name: str = "app_logs", location: str | None = None) -> str:
    """app_logs (9 columns, load time, run and batch) if it does not exist yet.
    Its location is the ``raw`` path of an app-log ingest; call ``refresh`` after
    loads."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(APP_LOG)}, `created_at` timestamp, `run_id` string, `batch_id` bigint)"
              f" USING parquet PARTITIONED BY (run_id, batch_id){loc}")
    return name


def create_access_log(spark: SparkSession, name: str = "access_log", location: str | None = None) -> str:
    """access_log partitioned by log_date and close (the day close adds a partition
    for the rows it flagged)."""
    loc = f" LOCATION '{location}'" if location else ""
    cols = [f for f in ACCESS_LOG.fields if f.name != "log_date"]
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}, `run_id` string, `batch_id` bigint, `etl_timestamp` timestamp,"
              f" `log_date` date, `close` string) USING parquet PARTITIONED BY (log_date, close){loc}")
    return name


def _close_spec(log_date: str, folder: str) -> str:
    return f"PARTITION (log_date = DATE '{log_date}', close = '{folder.rpartition('close=')[2]}')"


def add_close(spark: SparkSession, name: str, log_date: str, folder: str) -> None:
    """Make one close visible to SQL: a metadata change, all of its rows or none."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_close_spec(log_date, folder)} LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def drop_close(spark: SparkSession, name: str, log_date: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_close_spec(log_date, folder)}")
    spark.catalog.refreshTable(name)


def refresh(spark: SparkSession, name: str) -> None:
    """Make partitions that jobs wrote under a table's location visible to SQL."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
