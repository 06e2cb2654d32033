"""Batch loads in one pass: every line is parsed once and written once.

Valid rows and rejects come out of the same scan as one write partitioned by
``outcome`` (``valid`` / ``rejected``), instead of two filtered passes over
the parse (a filter on the reject reason would be pushed into the parse and
re-evaluate it). Readers take ``outcome=valid`` as the table; partition
pruning skips the rejects. Writes are dynamic partition overwrites keyed by
``load_id``, so re-running a load replaces its own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ustrip
from ..operators import access_log as al
from ..operators import app_log as ap



def outcome():
    return F.when(F.col("reason").isNull(), F.lit("valid")).otherwise(F.lit("rejected"))


def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def load_access_log(lines: DataFrame, path: str, load_id: str) -> None:
    """Day-file lines (file_name, line) -> ``path`` partitioned by
    (load_id, outcome, log_date)."""
    kept = al.cid_filter(lines.withColumn("raw", F.col("line")))
    tagged = al.parse_strict(kept, keep=["raw"]).withColumn("reason", al.length_violations())
    out = tagged.select(*al.ACCESS_LOG_COLUMNS, "reason", "raw",
                        F.lit(load_id).alias("load_id"), outcome().alias("outcome"))
    _write(out, path, ["load_id", "outcome", "log_date"])


def load_app_log(lines: DataFrame, path: str, load_id: str) -> None:
    """App-log lines -> ``path`` partitioned by (load_id, outcome)."""
    typed = ap.type_app_log(ap.parse_app_log(lines.withColumn("line", ustrip("line"))))
    out = typed.select(*ap.FIELDS, "reason", F.substring("raw", 1, 90).alias("preview90"), "raw",
                       F.lit(load_id).alias("load_id"), outcome().alias("outcome"))
    _write(out, path, ["load_id", "outcome"])


def read_outcome(spark: SparkSession, path: str, outcome: str = "valid") -> DataFrame:
    return spark.read.parquet(path).where(F.col("outcome") == F.lit(outcome))
