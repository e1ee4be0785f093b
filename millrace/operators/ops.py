"""Operations data: dead-letter growth and alerts, run history, health, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.ids import alert_hash
from millrace.functions.ordering import previous_value


# --- dead-letter alerts -------------------------------------------------------


def dlq_growth(snapshots: DataFrame) -> DataFrame:
    """Per (topic, snapshot): total offset and its growth, never below zero.

    ``snapshots`` has topic, snapshot_ts, partition, end_offset. The first
    snapshot of a topic grows from zero.
    """
    part = F.concat_ws(":", "topic", F.col("partition").cast("string"))
    totals = snapshots.groupBy("topic", "snapshot_ts").agg(
        F.sum("end_offset").alias("current_total"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(part, "end_offset")))).alias(
            "offsets"
        ),
    )
    followed = previous_value(
        totals,
        ["topic"],
        "snapshot_ts",
        "current_total",
        "previous_total",
        F.to_date("snapshot_ts"),
    ).withColumn("previous_total", F.coalesce("previous_total", F.lit(0).cast("long")))
    return followed.withColumn(
        "growth",
        F.greatest(F.lit(0).cast("long"), F.col("current_total") - F.col("previous_total")),
    )


def severity(growth: Column, warning: int = 1, critical: int = 20) -> Column:
    return (
        F.when(growth >= critical, "CRITICAL")
        .when(growth >= warning, "WARNING")
        .otherwise("NONE")
    )


def alert_message(level: Column, growth: Column, topic: Column) -> Column:
    return F.format_string("%s: %d more dead letters (%s)", topic, growth, F.lower(level))


def alert_rows(
    growth: DataFrame,
    history: DataFrame | None = None,
    suppress_minutes: int = 10,
    warning: int = 1,
    critical: int = 20,
) -> DataFrame:
    """New rows of the alert history: one per (hash, time bucket).

    Snapshots without growth raise nothing; alerts already in ``history`` are
    left out.
    """
    level = severity(F.col("growth"), warning, critical)
    alerts = (
        growth.withColumn("severity", level)
        .filter(F.col("severity") != "NONE")
        .select(
            alert_hash(F.col("severity"), F.col("topic"), F.col("offsets")).alias("alert_hash"),
            times.floor_minutes(F.col("snapshot_ts"), suppress_minutes).alias("time_bucket"),
            "severity",
            F.col("topic").alias("topic_name"),
            F.col("offsets").alias("partition_offsets"),
            alert_message(F.col("severity"), F.col("growth"), F.col("topic")).alias("message"),
            F.col("snapshot_ts").alias("notified_at"),
        )
    )
    keys = ["alert_hash", "time_bucket"]
    first = F.min_by(
        F.struct("severity", "topic_name", "partition_offsets", "message", "notified_at"),
        "notified_at",
    )
    single = alerts.groupBy(*keys).agg(first.alias("row")).select(*keys, "row.*")
    if history is None:
        return single
    return single.join(history.select(*keys), keys, "left_anti")


# --- retention ----------------------------------------------------------------


def kept(df: DataFrame, date_column: str, as_of: object, days: int = 30) -> DataFrame:
    """Rows on or after the cut-off date; a partition filter on a date column."""
    return df.filter(times.last_days(F.col(date_column), as_of, days))


def expired_dates(df: DataFrame, date_column: str, as_of: object, days: int = 30) -> DataFrame:
    """Dates before the cut-off with their row counts."""
    old = df.filter(~times.last_days(F.col(date_column), as_of, days))
    return old.groupBy(date_column).agg(F.count("*").alias("dropped_rows"))


# --- run history --------------------------------------------------------------


def run_started(runs: DataFrame, name: str, at: Column | None = None) -> DataFrame:
    """RUNNING rows for frames of (run_id, run_date)."""
    begun = F.current_timestamp() if at is None else at
    return runs.select(
        "run_id",
        F.lit(name).alias("pipeline_name"),
        "run_date",
        begun.alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("long").alias("records_processed"),
        F.lit(None).cast("string").alias("error_message"),
        begun.alias("recorded_at"),
    )


def run_ended(
    started: DataFrame,
    status: str | Column = "SUCCESS",
    records: int | Column | None = None,
    error: str | Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Closing rows of started runs; appended, never updated in place."""
    done = F.current_timestamp() if at is None else at
    return started.withColumns(
        {
            "end_time": done,
            "status": times.as_column(status),
            "records_processed": times.as_column(records).cast("long"),
            "error_message": times.as_column(error).cast("string"),
            "recorded_at": done,
        }
    )


def latest_runs(history: DataFrame) -> DataFrame:
    """Current state of each run: the row recorded last."""
    rest = [c for c in history.columns if c != "run_id"]
    last = F.max_by(F.struct(*rest), F.struct("recorded_at", F.col("status") != "RUNNING"))
    return history.groupBy("run_id").agg(last.alias("row")).select("run_id", "row.*")


# --- table checks -------------------------------------------------------------


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str] = ("session_id", "window_start", "anomaly_type", "detected_at"),
) -> DataFrame:
    """Business keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def table_health(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, row_count, last_update) per table; values are (frame, time column)."""
    parts = [
        df.agg(
            F.count("*").alias("row_count"),
            F.max(F.col(column).cast("timestamp")).alias("last_update"),
        ).select(F.lit(name).alias("table_name"), "row_count", "last_update")
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame], date: object) -> DataFrame:
    """(table_name, count) of one metric date."""
    day = times.as_column(date).cast("date")
    parts = [
        df.filter(F.col("metric_date") == day)
        .agg(F.count("*").alias("count"))
        .select(F.lit(name).alias("table_name"), "count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
