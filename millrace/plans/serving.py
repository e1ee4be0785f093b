"""Serving queries and views over the result tables.

Look-backs take ``as_of`` instead of the server's clock. An unknown session or
date gives an empty frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.percentiles import exact_percentiles
from millrace.functions.values import rounded
from millrace.operators.ops import table_health
from millrace.schemas import FUNNEL_STAGES

ANOMALY_FIELDS = [
    "event_id",
    "session_id",
    "detected_at",
    "window_start",
    "window_end",
    "click_count",
    "unique_items",
    "anomaly_score",
    "anomaly_type",
]


def _check(name: str, value: int, low: int, high: int) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")


def _mean(column: str) -> Column:
    """Mean over an exact decimal sum, so row order cannot change it."""
    total = F.sum(F.col(column).cast("decimal(28,9)")).cast("double")
    return total / F.nullif(F.count(column), F.lit(0))


def stage_order(stage: Column) -> Column:
    order = F.lit(None).cast("int")
    for place, name in reversed(list(enumerate(FUNNEL_STAGES, 1))):
        order = F.when(stage == name, place).otherwise(order)
    return order


# --- anomalies ----------------------------------------------------------------


def anomaly_filter(
    df: DataFrame, anomaly_type: str | None = None, min_score: float | None = None
) -> DataFrame:
    if anomaly_type:
        df = df.filter(F.col("anomaly_type") == anomaly_type)
    if min_score is not None:
        df = df.filter(F.col("anomaly_score") >= min_score)
    return df


def recent_anomalies(
    anomalies: DataFrame,
    limit: int = 100,
    anomaly_type: str | None = None,
    min_score: float | None = None,
) -> DataFrame:
    _check("limit", limit, 1, 1000)
    found = anomaly_filter(anomalies, anomaly_type, min_score).select(*ANOMALY_FIELDS)
    return found.orderBy(F.desc("detected_at"), "event_id").limit(limit)


def anomaly_types(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("anomaly_type")
        .agg(
            F.count("*").alias("count"),
            _mean("anomaly_score").alias("avg_score"),
            F.max("detected_at").alias("last_detected"),
        )
        .orderBy(F.desc("count"), "anomaly_type")
    )


def anomaly_timeline(anomalies: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """Per hour: anomalies, distinct sessions, mean score."""
    _check("hours", hours, 1, 168)
    recent = anomalies.filter(times.last_hours(F.col("detected_at"), as_of, hours))
    sessions = recent.groupBy(
        F.date_trunc("hour", "detected_at").alias("hour"), "session_id"
    ).agg(
        F.count("*").alias("n"),
        F.sum(F.col("anomaly_score").cast("decimal(28,9)")).alias("score"),
    )
    return (
        sessions.groupBy("hour")
        .agg(
            F.sum("n").alias("anomaly_count"),
            F.count("session_id").alias("unique_sessions"),
            (F.sum("score").cast("double") / F.sum("n")).alias("avg_score"),
        )
        .orderBy(F.desc("hour"))
    )


def anomalies_for_session(anomalies: DataFrame, session_id: int) -> DataFrame:
    found = anomalies.filter(F.col("session_id") == session_id)
    return found.select(*ANOMALY_FIELDS).orderBy(F.desc("detected_at"), "event_id")


def view_recent_anomalies(anomalies: DataFrame, as_of: object) -> DataFrame:
    """The last 24 hours with the minutes between first and last event."""
    recent = anomalies.filter(times.last_hours(F.col("detected_at"), as_of, 24))
    minutes = times.window_minutes(F.col("first_event_ts"), F.col("last_event_ts"))
    return recent.select(*ANOMALY_FIELDS, minutes.alias("window_duration_minutes")).orderBy(
        F.desc("detected_at"), "event_id"
    )


# --- daily metrics ------------------------------------------------------------


def _daily_columns(daily: DataFrame) -> DataFrame:
    return daily.select(
        "metric_date",
        "total_clicks",
        "total_purchases",
        "unique_sessions",
        "unique_items",
        rounded(F.col("conversion_rate"), 4).alias("conversion_rate"),
        rounded(F.col("avg_session_duration_sec"), 2).alias("avg_session_duration_sec"),
        rounded(F.col("avg_clicks_per_session"), 2).alias("avg_clicks_per_session"),
        "total_revenue",
        rounded(F.col("avg_order_value"), 2).alias("avg_order_value"),
    )


def daily_metrics_range(
    daily: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    wanted = daily.filter(times.between_dates(F.col("metric_date"), start, end))
    return _daily_columns(wanted).orderBy("metric_date")


def daily_metrics_for(daily: DataFrame, date: str | dt.date) -> DataFrame:
    return _daily_columns(daily.filter(F.col("metric_date") == F.lit(times.parse_date(date))))


def metrics_summary(daily: DataFrame, as_of: object, days: int = 7) -> DataFrame:
    _check("days", days, 1, 90)
    recent = daily.filter(times.last_days(F.col("metric_date"), as_of, days))
    return recent.agg(
        F.count("*").cast("int").alias("days_processed"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_purchases").alias("total_purchases"),
        F.sum("unique_sessions").alias("total_sessions"),
        rounded(_mean("conversion_rate"), 4).alias("avg_conversion_rate"),
        F.round(F.sum("total_revenue"), 0).cast("long").alias("total_revenue"),
        rounded(_mean("avg_clicks_per_session"), 2).alias("avg_clicks_per_session"),
    )


def view_daily_summary(daily: DataFrame, as_of: object) -> DataFrame:
    """The last 30 days with rate in percent and duration in minutes."""
    recent = daily.filter(times.last_days(F.col("metric_date"), as_of, 30))
    purchases = F.col("total_purchases")
    order_value = rounded(F.col("total_revenue").cast("double") / purchases, 2)
    rate = F.col("conversion_rate").cast("decimal(28,10)") * 100
    minutes = F.col("avg_session_duration_sec") / F.lit(60.0)
    return recent.select(
        "metric_date",
        "total_clicks",
        "total_purchases",
        "unique_sessions",
        F.round(rate, 2).cast("double").alias("conversion_rate_pct"),
        rounded(F.col("avg_clicks_per_session"), 2).alias("avg_clicks_per_session"),
        rounded(minutes, 2).alias("avg_session_duration_minutes"),
        "total_revenue",
        F.when(purchases > 0, order_value).otherwise(0.0).alias("avg_order_value"),
    ).orderBy(F.desc("metric_date"))


# --- funnel -------------------------------------------------------------------


def funnel_for(funnel: DataFrame, date: str | dt.date) -> DataFrame:
    wanted = funnel.filter(F.col("metric_date") == F.lit(times.parse_date(date)))
    return wanted.orderBy(stage_order(F.col("funnel_stage"))).select(
        "funnel_stage",
        "session_count",
        rounded(F.col("percentage"), 2).alias("percentage"),
        rounded(F.col("drop_rate"), 4).alias("drop_rate"),
    )


def view_latest_funnel(funnel: DataFrame) -> DataFrame:
    """Stages of the latest date; the date is a scalar subquery."""
    latest = funnel.select(F.max("metric_date")).scalar()
    drop = F.col("drop_rate").cast("decimal(28,10)") * 100
    return (
        funnel.filter(F.col("metric_date") == latest)
        .orderBy(stage_order(F.col("funnel_stage")))
        .select(
            "funnel_stage",
            "session_count",
            rounded(F.col("percentage"), 2).alias("percentage"),
            F.round(drop, 2).cast("double").alias("drop_rate_pct"),
        )
    )


# --- items and categories -----------------------------------------------------


def popular_items_for(items: DataFrame, date: str | dt.date, limit: int = 50) -> DataFrame:
    _check("limit", limit, 1, 500)
    wanted = items.filter(F.col("metric_date") == F.lit(times.parse_date(date)))
    return (
        wanted.orderBy("rank")
        .limit(limit)
        .select(
            "item_id",
            "category",
            "click_count",
            "purchase_count",
            "revenue",
            "rank",
            rounded(F.col("click_to_purchase_ratio"), 2).alias("click_to_purchase_ratio"),
        )
    )


def popular_categories_for(
    categories: DataFrame, date: str | dt.date, limit: int = 20
) -> DataFrame:
    _check("limit", limit, 1, 100)
    wanted = categories.filter(F.col("metric_date") == F.lit(times.parse_date(date)))
    return (
        wanted.orderBy("rank")
        .limit(limit)
        .select("category", "click_count", "purchase_count", "unique_items", "revenue", "rank")
    )


def _trending(items: DataFrame, as_of: object, days: int, limit: int) -> DataFrame:
    recent = items.filter(times.last_days(F.col("metric_date"), as_of, days))
    mean_rank = F.sum("rank").cast("decimal(18,0)") / F.count("*").cast("decimal(18,0)")
    return (
        recent.groupBy("item_id", "category")
        .agg(
            F.sum("click_count").alias("total_clicks"),
            F.sum("purchase_count").alias("total_purchases"),
            F.sum("revenue").alias("total_revenue"),
            F.round(mean_rank, 1).cast("double").alias("avg_rank"),
        )
        .orderBy(F.desc("total_revenue"), "item_id", F.col("category").asc_nulls_last())
        .limit(limit)
    )


def trending_items(
    items: DataFrame, as_of: object, days: int = 7, limit: int = 20
) -> DataFrame:
    _check("days", days, 1, 30)
    _check("limit", limit, 1, 100)
    return _trending(items, as_of, days, limit)


def view_top_items(items: DataFrame, as_of: object) -> DataFrame:
    return _trending(items, as_of, 7, 50)


# --- whole system -------------------------------------------------------------


def system_stats(anomalies: DataFrame, daily: DataFrame, items: DataFrame) -> DataFrame:
    """One row of three counts and two last dates; one scalar subquery per table."""

    def figures(df: DataFrame, last: str) -> Column:
        return df.agg(F.struct(F.count("*").alias("rows"), F.max(last).alias("last"))).scalar()

    found = anomalies.sparkSession.range(1).select(
        figures(anomalies, "detected_at").alias("anomalies"),
        figures(daily, "metric_date").alias("daily"),
        items.agg(F.count("*")).scalar().alias("items"),
    )
    return found.select(
        F.col("anomalies.rows").alias("total_anomalies"),
        F.col("daily.rows").alias("days_processed"),
        F.col("items").alias("total_popular_items"),
        F.col("anomalies.last").alias("last_anomaly_detected"),
        F.col("daily.last").alias("last_metrics_date"),
    )


def system_health(
    anomalies: DataFrame,
    daily: DataFrame,
    items: DataFrame,
    updated: str = "created_at",
) -> DataFrame:
    return table_health(
        {
            "anomaly_sessions": (anomalies, "detected_at"),
            "daily_metrics": (daily, updated),
            "popular_items": (items, updated),
        }
    )


def anomaly_tiles(anomalies: DataFrame) -> DataFrame:
    """Dashboard tiles of an anomaly selection: rows, mean score, most clicks."""
    return anomalies.agg(
        F.count("*").alias("total"),
        rounded(_mean("anomaly_score"), 2).alias("avg_score"),
        F.max("click_count").alias("max_clicks"),
    )


def daily_tiles(daily: DataFrame) -> DataFrame:
    """Dashboard tiles of a date range: sums and mean conversion."""
    return daily.agg(
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_purchases").alias("total_purchases"),
        rounded(_mean("conversion_rate"), 4).alias("avg_conversion"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def score_quartiles(anomalies: DataFrame) -> DataFrame:
    """Minimum, quartiles and maximum of the scores in one row."""
    found = exact_percentiles(anomalies, ["anomaly_score"], [0.0, 0.25, 0.5, 0.75, 1.0])
    names = {0.0: "lowest", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "highest"}
    return found.agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("percentile"))).alias(name)
            for p, name in names.items()
        ]
    )
