"""Trending items from heavy-hitter sketches that merge over time.

A sketch tracks a bounded number of items, however many there are. Tasks sketch
their own rows first, and sketches of one stretch of time from different batches
are merged when they are read, so any range is ranked without a rescan of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Items that a sketch tracks.
CAPACITY = 10_000

#: The largest error of a count is at most this share of the events of its
#: group, divided by the number of items tracked.
ERROR_FACTOR = 3.5


def item_sketches(clicks: DataFrame, width: str = "1 hour", capacity: int = CAPACITY) -> DataFrame:
    """A sketch of the items clicked in each ``width`` of event time, and the clicks.

    Rows without an item or a time are left out.
    """
    return (
        clicks.filter(F.col("item_id").isNotNull() & F.col("event_ts").isNotNull())
        .groupBy(F.window("event_ts", width)["start"].alias("bucket"))
        .agg(
            F.expr(f"approx_top_k_accumulate(item_id, {int(capacity)})").alias("items"),
            F.count("*").alias("clicks"),
        )
    )


def trending(
    sketches: DataFrame, *by: Column | str, limit: int = 20, capacity: int = CAPACITY
) -> DataFrame:
    """The most clicked items of each group of sketches: item_id, clicks, rank,
    group_clicks and most_error.

    Counts are exact, and ``most_error`` zero, for groups of no more than three
    quarters of ``capacity`` items. Beyond that a count is at most ``most_error``
    too high, and items that cannot be told from the rest are left out. Equal
    counts are ordered by item.
    """
    # Without a key, Spark cannot write the empty sketch of a task that had no rows.
    merged = sketches.groupBy(*(by or [F.lit(0).alias("all")])).agg(
        F.expr(f"approx_top_k_combine(items, {int(capacity)})").alias("items"),
        F.sum("clicks").alias("group_clicks"),
    )
    groups = merged.columns[: len(by)]
    found = merged.select(
        *groups,
        "group_clicks",
        # All tracked items, so that equal counts at the limit have a fixed order.
        F.expr(f"approx_top_k_estimate(items, {int(capacity)})").alias("found"),
    )
    tracked = F.aggregate("found", F.lit(0).cast("long"), lambda n, x: n + x["count"])
    error = F.when(tracked == F.col("group_clicks"), F.lit(0).cast("long")).otherwise(
        F.ceil(F.col("group_clicks") * ERROR_FACTOR / capacity)
    )
    rows = found.select(
        *groups, "group_clicks", error.alias("most_error"), F.explode("found").alias("one")
    )
    # A group has no more rows than a sketch tracks items.
    order = Window.partitionBy(*groups).orderBy(F.desc("one.count"), "one.item")
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
        .select(
            *groups,
            F.col("one.item").alias("item_id"),
            F.col("one.count").alias("clicks"),
            "rank",
            "group_clicks",
            "most_error",
        )
    )
