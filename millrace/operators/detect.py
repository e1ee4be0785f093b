"""Abnormal sessions in event-time windows; the same code for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ids import anomaly_id

HIGH_FREQUENCY_CLICKS = 50
BOT_CLICKS = 50
BOT_DIVERSITY = 0.1

COLUMNS = [
    "event_id",
    "event_ts",
    "session_id",
    "detected_at",
    "window_start",
    "window_end",
    "first_event_ts",
    "last_event_ts",
    "click_count",
    "unique_items",
    "anomaly_score",
    "anomaly_type",
    "kafka_ingest_ts",
    "spark_process_ts",
    "source",
]


def session_windows(
    events: DataFrame, size: str, slide: str | None = None, exact: bool = True
) -> DataFrame:
    """Per (window, session): clicks, distinct items, first/last event, last ingest.

    Exact distinct items need a digest per item first and so work on static
    frames; a stream uses the sketch, which keeps its state small and fixed.
    """
    window = F.window("event_ts", size, slide)
    if exact:
        if events.isStreaming:
            raise ValueError("exact distinct items are not available on a stream")
        per_item = events.groupBy(window.alias("window"), "session_id", "item_id").agg(
            F.count("*").alias("n"),
            F.min("event_ts").alias("first_event_ts"),
            F.max("event_ts").alias("last_event_ts"),
            F.max("kafka_ingest_ts").alias("kafka_ingest_ts"),
        )
        grouped = per_item.groupBy("window", "session_id").agg(
            F.sum("n").alias("click_count"),
            F.count("item_id").alias("unique_items"),
            F.min("first_event_ts").alias("first_event_ts"),
            F.max("last_event_ts").alias("last_event_ts"),
            F.max("kafka_ingest_ts").alias("kafka_ingest_ts"),
        )
    else:
        grouped = events.groupBy(window.alias("window"), "session_id").agg(
            F.count("*").alias("click_count"),
            F.approx_count_distinct("item_id").alias("unique_items"),
            F.min("event_ts").alias("first_event_ts"),
            F.max("event_ts").alias("last_event_ts"),
            F.max("kafka_ingest_ts").alias("kafka_ingest_ts"),
        )
    return grouped.select(
        "session_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "first_event_ts",
        "last_event_ts",
        "click_count",
        "unique_items",
        "kafka_ingest_ts",
    )


def _as_anomaly(df: DataFrame, kind: str, score: Column, source: str) -> DataFrame:
    """Result columns. The id rests on the window's own start, which late or
    out-of-order events cannot move; detection time is the last event."""
    return (
        df.withColumn("anomaly_score", score)
        .withColumn("anomaly_type", F.lit(kind))
        .withColumn("detected_at", F.col("last_event_ts"))
        .withColumn("event_ts", F.unix_seconds("first_event_ts") * 1000)
        .withColumn(
            "event_id", anomaly_id(F.col("session_id"), F.col("window_start"), kind)
        )
        .withColumn("spark_process_ts", F.current_timestamp())
        .withColumn("source", F.lit(source))
        .select(*COLUMNS)
    )


def high_frequency(
    windows: DataFrame, threshold: int = HIGH_FREQUENCY_CLICKS, source: str = "spark_streaming"
) -> DataFrame:
    """Windows with more than ``threshold`` clicks; score = clicks / threshold."""
    hits = windows.filter(F.col("click_count") > threshold)
    return _as_anomaly(
        hits, "HIGH_FREQUENCY", F.col("click_count") / F.lit(float(threshold)), source
    )


def bot_like(
    windows: DataFrame,
    threshold: int = BOT_CLICKS,
    diversity: float = BOT_DIVERSITY,
    source: str = "spark_streaming",
    retract: bool = False,
) -> DataFrame:
    """Many clicks on few items: distinct / clicks under ``diversity``.

    Score = clicks / threshold x (1 - distinct / clicks). More events can lift the
    diversity of a window that was a hit, so with ``retract`` the other windows of
    many clicks come out too, without a score (:func:`standing`).
    """
    spread = F.col("unique_items").cast("double") / F.col("click_count").cast("double")
    busy = windows.filter(F.col("click_count") > threshold)
    score = F.col("click_count") / F.lit(float(threshold)) * (1 - spread)
    if retract:
        return _as_anomaly(busy, "BOT_LIKE", F.when(spread < diversity, score), source)
    return _as_anomaly(busy.filter(spread < diversity), "BOT_LIKE", score, source)


def standing(anomalies: DataFrame) -> DataFrame:
    """Without the rows that take back an earlier anomaly of their key."""
    return anomalies.filter(F.col("anomaly_score").isNotNull())


def detect_high_frequency(
    events: DataFrame,
    size: str = "10 seconds",
    threshold: int = HIGH_FREQUENCY_CLICKS,
    exact: bool | None = None,
) -> DataFrame:
    """Tumbling windows. ``exact`` defaults to yes on static frames."""
    exact = not events.isStreaming if exact is None else exact
    return high_frequency(session_windows(events, size, exact=exact), threshold)


def detect_bot_like(
    events: DataFrame,
    size: str = "1 minute",
    slide: str = "30 seconds",
    threshold: int = BOT_CLICKS,
    diversity: float = BOT_DIVERSITY,
    exact: bool | None = None,
) -> DataFrame:
    """Sliding windows. ``exact`` defaults to yes on static frames.

    A stream also takes back windows that are hits no longer.
    """
    exact = not events.isStreaming if exact is None else exact
    windows = session_windows(events, size, slide, exact)
    return bot_like(windows, threshold, diversity, retract=events.isStreaming)
