"""Window counts from panes, exact and in parts that can be merged.

A pane is the longest stretch of time that every window of the detectors is made
of. One row for each (pane, session, item) serves tumbling and sliding windows of
all lengths, counts distinct items exactly, and two sets of such rows for the
same events' time merge by plain sums.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units of the lengths of windows.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

KEYS = ["pane_start", "session_id", "item_id"]


def seconds(length: str) -> int:
    """"30 seconds" as a number."""
    number, unit = length.split()
    return int(number) * UNITS[unit.removesuffix("s")]


def pane_seconds(*lengths: str) -> int:
    """Length of the panes of windows with these sizes and slides."""
    return math.gcd(*map(seconds, lengths))


def digest(events: DataFrame, pane: int) -> DataFrame:
    """One row per pane, session and item: clicks, first and last event, last ingest."""
    start = F.timestamp_seconds(F.floor(F.unix_seconds("event_ts") / pane) * pane)
    return events.groupBy(start.alias("pane_start"), "session_id", "item_id").agg(
        F.count("*").alias("clicks"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.max("kafka_ingest_ts").alias("kafka_ingest_ts"),
    )


def _merged(*more):
    return [
        F.sum("clicks").alias("clicks"),
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
        F.max("kafka_ingest_ts").alias("kafka_ingest_ts"),
        *more,
    ]


def merge(stored: DataFrame, new: DataFrame, batch: int) -> DataFrame:
    """Both sets of rows as one; ``changed_in`` is the last batch with events of a row."""
    both = stored.unionByName(new.withColumn("changed_in", F.lit(batch).cast("long")))
    return both.groupBy(*KEYS).agg(*_merged(F.max("changed_in").alias("changed_in")))


def windows(panes: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Rows as :func:`millrace.operators.detect.session_windows` gives them, with
    the last batch that changed the window."""
    window = F.window("pane_start", size, slide)
    per_item = panes.groupBy(window.alias("window"), "session_id", "item_id").agg(
        *_merged(F.max("changed_in").alias("changed_in"))
    )
    return per_item.groupBy("window", "session_id").agg(
        *_merged(F.count("item_id").alias("unique_items"), F.max("changed_in").alias("changed_in"))
    ).select(
        "session_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "first_event_ts",
        "last_event_ts",
        F.col("clicks").alias("click_count"),
        "unique_items",
        "kafka_ingest_ts",
        "changed_in",
    )
