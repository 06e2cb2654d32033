"""Order messages: JSON encode (producer side) and decode (consumer side)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..schemas import ORDER_MESSAGE

REQUIRED = [f.name for f in ORDER_MESSAGE.fields]


def encode_orders(orders: DataFrame) -> DataFrame:
    """Order rows -> keyed messages: key = order_id as text, value = JSON."""
    return orders.select(F.col("order_id").cast("string").alias("key"),
                         F.to_json(F.struct(*REQUIRED)).alias("value"))


def decode_orders(messages: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text (or bytes) -> order columns, with a reject reason for a missing
    value, undecodable bytes, anything but one JSON object, and missing or
    mistyped fields (the columns of a rejected row are NULL).

    The text is parsed as the only element of an array, so an object followed
    by more text is malformed instead of silently cut."""
    keep = list(keep or [])
    text = F.try_validate_utf8(F.col(value).cast("string"))
    parsed = messages.select(*keep, F.col(value).isNull().alias("__none"), text.alias("raw"),
                             F.from_json(F.concat(F.lit("["), text, F.lit("]")), ArrayType(ORDER_MESSAGE),
                                         {"mode": "PERMISSIVE"}).alias("__all"))
    one = F.when(F.size("__all") == 1, F.get("__all", F.lit(0)))
    parsed = parsed.select(*keep, "__none", "raw", one.alias("__o"))
    bad = F.concat_ws(", ", *[F.when(F.col(f"__o.{c}").isNull(), F.lit(c)) for c in REQUIRED])
    reason = (F.when(F.col("__none"), F.lit("value is missing"))
              .when(F.col("raw").isNull(), F.lit("value is not UTF-8"))
              .when(F.col("__o").isNull() | F.col("__o.order_id").isNull(), F.lit("not an order message"))
              .when(bad != "", F.concat(F.lit("missing or mistyped: "), bad)))
    tagged = parsed.select(*keep, "raw", "__o", reason.alias("reason"))
    return tagged.select(*keep, "raw", *[F.when(F.col("reason").isNull(), F.col(f"__o.{c}")).alias(c) for c in REQUIRED], "reason")
