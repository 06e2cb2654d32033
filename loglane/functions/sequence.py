"""Dense per-group sequence numbers without a one-task-per-group window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_rank_in_groups(df: DataFrame, group_cols: list[str], order_col: str,
                         out_col: str, bucket_width: int = 1 << 20) -> DataFrame:
    """0-based position of each row within its group, ordered by ``order_col``
    (unique within a group), like ``row_number() - 1`` over the group.

    A plain window sends a whole group to one task; one key may hold a third
    of all rows. Here the order key is cut into fixed-width buckets: a small
    table of per-bucket counts gives each bucket's starting position (prefix
    sum), and the row_number runs per (group, bucket), which holds at most
    ``bucket_width`` rows. Rows with a NULL in ``group_cols`` form a group of
    their own, as in a window."""
    b = "__bucket"
    keyed = df.withColumn(b, F.floor(F.col(order_col) / F.lit(bucket_width)))
    keys = group_cols + [b]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    w_prefix = (Window.partitionBy(*group_cols).orderBy(b)
                .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(w_prefix), F.lit(0)).alias("__start"))
    w_local = Window.partitionBy(*keys).orderBy(order_col)
    named = starts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__start")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return (keyed.join(named, same)
            .withColumn(out_col, (F.col("__start") + F.row_number().over(w_local) - 1).cast("long"))
            .select(*df.columns, out_col))
