"""Clicks and purchases as one narrow frame, and its per-session digest.

Keeping both kinds in one frame lets every daily report group once by its key
instead of grouping each side and joining afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import line_revenue

COLUMNS = ["metric_date", "kind", "session_id", "item_id", "category", "event_ms", "revenue"]


def is_click() -> Column:
    return F.col("kind") == "click"


def is_purchase() -> Column:
    return F.col("kind") == "purchase"


def activity_from_events(events: DataFrame) -> DataFrame:
    """From one frame with ``kind``; price and quantity are read on purchases only."""
    return events.select(
        "metric_date",
        "kind",
        "session_id",
        "item_id",
        F.when(is_click(), F.col("category")).alias("category"),
        "event_ms",
        F.when(is_purchase(), line_revenue(F.col("price"), F.col("quantity"))).alias("revenue"),
    )


def activity(clicks: DataFrame, purchases: DataFrame) -> DataFrame:
    """From the two separate sources."""
    none = F.lit(None)
    left = clicks.select(
        *clicks_columns("click", F.col("category").cast("string")),
        none.cast("decimal(23,2)").alias("revenue"),
    )
    right = purchases.select(
        *clicks_columns("purchase", none.cast("string")),
        line_revenue(F.col("price"), F.col("quantity")).cast("decimal(23,2)").alias("revenue"),
    )
    return left.unionByName(right)


def clicks_columns(kind: str, category: Column) -> list[Column | str]:
    return [
        "metric_date",
        F.lit(kind).alias("kind"),
        "session_id",
        "item_id",
        category.alias("category"),
        "event_ms",
    ]


# The reports take activity rows or hourly sums of them (partials.py).


def clicks_in(rows: DataFrame) -> Column:
    """Clicks of a group."""
    return F.sum("clicks") if "clicks" in rows.columns else F.count_if(is_click())


def purchases_in(rows: DataFrame) -> Column:
    """Purchases of a group."""
    return F.sum("purchases") if "purchases" in rows.columns else F.count_if(is_purchase())


def click_span_in(rows: DataFrame) -> Column:
    """Milliseconds between the first and the last click of a group."""
    if "first_click_ms" in rows.columns:
        return F.max("last_click_ms") - F.min("first_click_ms")
    click_ms = F.when(is_click(), F.col("event_ms"))
    return F.max(click_ms) - F.min(click_ms)


def session_sums(rows: DataFrame) -> list[Column]:
    """What a group of clicks and purchases amounts to."""
    return [
        clicks_in(rows).alias("click_count"),
        click_span_in(rows).alias("click_span_ms"),
        purchases_in(rows).alias("purchase_count"),
        F.sum("revenue").alias("revenue"),
    ]


def session_facts(act: DataFrame) -> DataFrame:
    """One row per (date, session): clicks, click span in ms, purchases, revenue."""
    return act.groupBy("metric_date", "session_id").agg(*session_sums(act))
