"""Declared schemas: the message envelope, the two target tables, rejects."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, DateType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

# Record envelope: the shape of Spark's Kafka source. Text sources are
# adapted to it so one set of operators serves files and topics.
ENVELOPE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

ORDER_MESSAGE = StructType([
    StructField("order_id", LongType()),
    StructField("customer", StringType()),
    StructField("item", StringType()),
    StructField("quantity", LongType()),
])

APP_LOG = StructType([
    StructField("timestamp", TimestampNTZType()),
    StructField("level", StringType()),
    StructField("user_id", StringType()),
    StructField("endpoint", StringType()),
    StructField("method", StringType()),
    StructField("status", IntegerType()),
    StructField("duration_ms", IntegerType()),
    StructField("ip", StringType()),
    StructField("error", StringType()),
])

ACCESS_LOG = StructType([
    StructField("file_name", StringType()),
    StructField("log_date", DateType()),
    StructField("log_time", StringType()),
    StructField("ip", StringType()),
    StructField("login", StringType()),
    StructField("cid", StringType()),
    StructField("device", StringType()),
    StructField("server", StringType()),
    StructField("flag", StringType()),
    StructField("investor", StringType()),
])

REJECTS = StructType([
    StructField("source", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("reason", StringType()),
    StructField("preview90", StringType()),
    StructField("raw", StringType()),
])

# Column length limits of the target tables (VARCHAR(n)).
APP_LOG_LIMITS = {"level": 10, "user_id": 20, "endpoint": 100, "method": 10, "ip": 45}
ACCESS_LOG_LIMITS = {"file_name": 100, "log_time": 20, "ip": 45, "login": 50, "cid": 64,
                     "device": 100, "server": 150, "flag": 10, "investor": 5}

ACCESS_LOG_COLUMNS = [f.name for f in ACCESS_LOG.fields]
APP_LOG_COLUMNS = [f.name for f in APP_LOG.fields]


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
