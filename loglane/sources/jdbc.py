"""Relational-database edge: set-based appends through Spark's JDBC writer.

The reference inserts rows one at a time or in client-side batches. Here a
DataFrame (a micro-batch, or a day's flagged partition) is appended in
``batchsize`` statements per task. The JDBC driver jar is not part of this
installation, so only option building is tested."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batchsize: int = 500, driver: str | None = None, extra: dict | None = None) -> dict:
    o = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if driver:
        o["driver"] = driver
    o.update(extra or {})
    return o


def jdbc_append(df: DataFrame, url: str, table: str, **kw) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **kw)).mode("append").save()
