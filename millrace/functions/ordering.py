"""The row before, without ordering a whole series in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.joins import null_safe_join


def previous_value(
    df: DataFrame, by: Sequence[str], order: str, value: str, name: str, bucket: Column
) -> DataFrame:
    """Add ``name``: ``value`` of the row before within ``by`` when ordered by ``order``.

    ``bucket`` must grow with ``order`` (a day, a block of batch numbers). Rows
    are ordered inside a bucket only; the first row of a bucket takes the last
    value of the bucket before it, found on one row per bucket.
    """
    keys = [*by, "_bucket"]
    marked = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys).orderBy(order)
    across = Window.partitionBy(*by).orderBy("_bucket")
    ends = (
        marked.groupBy(*keys)
        .agg(F.max_by(value, order).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(across))
        .drop("_last")
    )
    rows = marked.withColumn("_place", F.row_number().over(inside)).withColumn(
        "_before", F.lag(value).over(inside)
    )
    return (
        null_safe_join(rows, ends, keys, "left")
        .withColumn(
            name, F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before"))
        )
        .drop("_bucket", "_place", "_before", "_carried")
    )
