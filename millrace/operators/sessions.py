"""One summary row per session.

:func:`session_summary` takes all activity at once. :func:`digests` and
:func:`summaries` do the same in two steps, so that days can be run one by one:
digests of days are stored, and a session over midnight is put together from the
days that it has. A session ends when a whole day passes without an event of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.activity import is_click, is_purchase


def session_summary(act: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Times, counts, distinct items, spend, flags and categories of a session.

    The (session, item) digest comes first, so distinct items are plain counts
    and a very busy session is spread over its items. Categories are gathered
    as a set whose size is bounded by the category domain. Both digests end up
    partitioned by session and join without another shuffle.
    """
    per_item = act.groupBy("session_id", "item_id").agg(
        F.count_if(is_click()).alias("clicks"),
        F.count_if(is_purchase()).alias("purchases"),
        F.min("event_ms").alias("first_ms"),
        F.max("event_ms").alias("last_ms"),
        F.sum("revenue").alias("revenue"),
    )
    categories = (
        act.filter(is_click() & F.col("category").isNotNull())
        .groupBy("session_id")
        .agg(F.array_sort(F.collect_set("category")).alias("categories_viewed"))
    )
    return _summary(per_item, categories, ["session_id"], anomalies)


#: A day's activity of a session and item, as it is stored.
DIGEST = T.StructType(
    [
        T.StructField("metric_date", T.DateType()),
        T.StructField("session_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("first_ms", T.LongType()),
        T.StructField("last_ms", T.LongType()),
        T.StructField("revenue", T.DecimalType(33, 2)),
    ]
)


def digests(act: DataFrame) -> DataFrame:
    """One row per (date, session, item, category) of ``act``."""
    keys = ["metric_date", "session_id", "item_id", "category"]
    found = act.groupBy(*keys).agg(
        F.count_if(is_click()).alias("clicks"),
        F.count_if(is_purchase()).alias("purchases"),
        F.min("event_ms").alias("first_ms"),
        F.max("event_ms").alias("last_ms"),
        F.sum("revenue").alias("revenue"),
    )
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIGEST])


def first_days(days: DataFrame) -> DataFrame:
    """``days(session_id, metric_date)``, distinct, with the ``first_day`` of the
    run of days without a gap that each belongs to."""
    order = Window.partitionBy("session_id").orderBy("metric_date")
    begins = F.coalesce(F.datediff("metric_date", F.lag("metric_date").over(order)) > 1, F.lit(True))
    return days.withColumn("_start", F.when(begins, F.col("metric_date"))).select(
        "session_id",
        "metric_date",
        F.last("_start", ignorenulls=True).over(order).alias("first_day"),
    )


def linked_days(
    sessions: DataFrame, step: int, rows_of: Callable[[int], DataFrame], keep: Callable[[DataFrame], DataFrame]
) -> list[DataFrame]:
    """Digests of the days before (``step`` -1) or after (1) on which ``sessions``
    go on without a gap, the nearest first.

    ``rows_of(n)`` are the digests n days away; ``keep`` writes a frame and reads
    it back. As many rounds as the longest of these sessions has days.
    """
    found: list[DataFrame] = []
    while True:
        rows = keep(rows_of(step * (len(found) + 1)).join(sessions, "session_id", "left_semi"))
        if rows.isEmpty():
            return found
        found.append(rows)
        sessions = rows.select("session_id").distinct()


def summaries(stored: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Summary rows from all digests of some sessions."""
    starts = first_days(stored.select("session_id", "metric_date").distinct())
    placed = stored.join(starts, ["session_id", "metric_date"])
    keys = ["session_id", "first_day"]
    per_item = placed.groupBy(*keys, "item_id").agg(
        F.sum("clicks").alias("clicks"),
        F.sum("purchases").alias("purchases"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
        F.sum("revenue").alias("revenue"),
    )
    categories = (
        placed.filter((F.col("clicks") > 0) & F.col("category").isNotNull())
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("category")).alias("categories_viewed"))
    )
    return _summary(per_item, categories, keys, anomalies)


def _summary(
    per_item: DataFrame, categories: DataFrame, keys: list[str], anomalies: DataFrame
) -> DataFrame:
    known = F.col("item_id").isNotNull()
    digest = per_item.groupBy(*keys).agg(
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
        F.sum("clicks").alias("click_count"),
        F.sum("purchases").alias("purchase_count"),
        F.count_if(known & (F.col("clicks") > 0)).alias("unique_items_viewed"),
        F.count_if(known & (F.col("purchases") > 0)).alias("unique_items_purchased"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(15,2)").alias("total_spent"),
    )
    flagged = anomalies.groupBy("session_id").agg(F.lit(True).alias("flag"))
    first = F.timestamp_millis("first_ms")
    return (
        digest.join(categories, keys, "left")
        .join(flagged, "session_id", "left")
        .select(
            "session_id",
            F.to_date(first).alias("metric_date"),
            first.alias("first_event_ts"),
            F.timestamp_millis("last_ms").alias("last_event_ts"),
            F.floor((F.col("last_ms") - F.col("first_ms")) / 1000)
            .cast("int")
            .alias("duration_sec"),
            "click_count",
            "purchase_count",
            "unique_items_viewed",
            "unique_items_purchased",
            "total_spent",
            (F.col("purchase_count") > 0).alias("is_converted"),
            F.coalesce("flag", F.lit(False)).alias("is_anomaly"),
            F.coalesce(
                "categories_viewed", F.array().cast("array<string>")
            ).alias("categories_viewed"),
        )
    )
