"""Row selection on expensive derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Rows of ``df`` where ``condition`` holds on columns that are costly to
    compute, such as a parse result.

    Catalyst pushes a filter below the projection that computes its columns
    and evaluates them there once more for each mention (generated filters do
    not share subexpressions). A row number beside the computed columns keeps
    the filter above them; columns that nobody reads are still pruned. Use a
    plain ``where`` on raw columns, and where later filters must reach the
    scan."""
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    return numbered.where(condition & (F.col("__row") >= 0)).select(*df.columns)
