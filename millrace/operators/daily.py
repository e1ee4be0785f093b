"""Daily totals, session averages and the daily metrics report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import line_revenue, ratio
from millrace.operators.activity import session_sums


def by_session_and_item(rows: DataFrame, *sums: Column) -> DataFrame:
    """``sums`` per (date, session) and per (date, item), from one scan.

    Every task sums both kinds of group before the one shuffle. ``of_items``
    tells the kinds apart.
    """
    day, session, item = F.col("metric_date"), F.col("session_id"), F.col("item_id")
    return rows.groupingSets([[day, session], [day, item]], day, session, item).agg(
        *sums, (F.grouping("session_id") == 1).alias("of_items")
    )


def click_totals(clicks: DataFrame) -> DataFrame:
    """Per date: clicks, distinct sessions, distinct items."""
    of_items = F.col("of_items")
    return (
        by_session_and_item(clicks, F.count("*").alias("n"))
        .groupBy("metric_date")
        .agg(
            F.sum(F.when(~of_items, F.col("n"))).alias("total_clicks"),
            F.count_if(~of_items).alias("unique_sessions"),
            F.count_if(of_items & F.col("item_id").isNotNull()).alias("unique_items"),
        )
    )


def purchase_totals(purchases: DataFrame) -> DataFrame:
    """Per date: purchases, distinct purchasing sessions, revenue."""
    sessions = purchases.groupBy("metric_date", "session_id").agg(
        F.count("*").alias("n"),
        F.sum(line_revenue(F.col("price"), F.col("quantity"))).alias("revenue"),
    )
    return sessions.groupBy("metric_date").agg(
        F.sum("n").alias("total_purchases"),
        F.count("*").alias("purchase_sessions"),
        F.sum("revenue").alias("total_revenue"),
    )


def click_sessions(clicks: DataFrame) -> DataFrame:
    """Per (date, session): clicks and duration in seconds."""
    span = F.max("event_ms") - F.min("event_ms")
    return clicks.groupBy("metric_date", "session_id").agg(
        F.count("*").alias("clicks_per_session"), (span / 1000.0).alias("duration_sec")
    )


def session_averages(clicks: DataFrame) -> DataFrame:
    """Per date: mean clicks and mean duration over sessions.

    Milliseconds are summed as integers, so the mean does not depend on order.
    """
    span = F.max("event_ms") - F.min("event_ms")
    sessions = clicks.groupBy("metric_date", "session_id").agg(
        F.count("*").alias("n"), span.alias("span_ms")
    )
    return sessions.groupBy("metric_date").agg(
        (F.sum("n").cast("double") / F.count("*")).alias("avg_clicks_per_session"),
        (F.sum("span_ms").cast("double") / 1000 / F.count("*")).alias(
            "avg_session_duration_sec"
        ),
    )


def daily_metrics(act: DataFrame) -> DataFrame:
    """All ten columns for every date that has clicks.

    Sessions and items are digested together, clicks and purchases too. Both
    meet as one row per date.
    Conversion is not clamped: sessions may buy without a click.
    """
    of_items, clicked = F.col("of_items"), F.col("click_count") > 0

    def session_sum(column: str) -> Column:
        return F.sum(F.when(~of_items, F.col(column)))

    per_date = (
        by_session_and_item(act, *session_sums(act))
        .groupBy("metric_date")
        .agg(
            session_sum("click_count").alias("total_clicks"),
            session_sum("purchase_count").alias("total_purchases"),
            F.count_if(~of_items & clicked).alias("unique_sessions"),
            F.count_if(~of_items & (F.col("purchase_count") > 0)).alias("purchase_sessions"),
            session_sum("click_span_ms").alias("span_ms"),
            session_sum("revenue").alias("total_revenue"),
            F.count_if(of_items & clicked & F.col("item_id").isNotNull()).alias("unique_items"),
        )
        .filter(F.col("total_clicks") > 0)
    )
    sessions = F.col("unique_sessions")
    return per_date.select(
        "metric_date",
        "total_clicks",
        "total_purchases",
        "unique_sessions",
        "unique_items",
        ratio(F.col("purchase_sessions"), sessions).alias("conversion_rate"),
        (F.col("span_ms").cast("double") / 1000 / sessions).alias("avg_session_duration_sec"),
        (F.col("total_clicks").cast("double") / sessions).alias("avg_clicks_per_session"),
        F.col("total_revenue").cast("decimal(15,2)").alias("total_revenue"),
        ratio(F.col("total_revenue"), F.col("total_purchases")).alias("avg_order_value"),
    )


def file_totals(purchases: DataFrame) -> DataFrame:
    """One row for a whole source: events, revenue, first and last event time."""
    return purchases.agg(
        F.count("*").alias("events"),
        F.sum(line_revenue(F.col("price"), F.col("quantity"))).alias("total_revenue"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
    )
