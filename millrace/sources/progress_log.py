"""Streaming-progress log: JSON Lines to one flat row per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import PROGRESS, TOPIC_OFFSETS


def read_progress_log(spark: SparkSession, path: str) -> DataFrame:
    """Log records; lines that are not JSON are skipped."""
    return spark.read.schema(PROGRESS).option("mode", "DROPMALFORMED").json(path)


def parse_progress_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from a frame of text lines."""
    parsed = lines.select(F.from_json(column, PROGRESS).alias("record"))
    return parsed.filter(F.col("record.event").isNotNull()).select("record.*")


def _sorted_entries(offsets: Column) -> Column:
    """Offset map as an ordered array, which can be compared."""
    return F.array_sort(F.map_entries(offsets))


def progress_rows(log: DataFrame, topic: str | None = None) -> DataFrame:
    """Flat progress records.

    name, run_id, batch_id, started_at, completed_at, input_rows,
    rows_per_second, trigger_ms, has_source, lag, start/end offsets (arrays of
    partition and offset), state_rows.
    """
    source = F.get("sources", F.lit(0))

    def offsets(field: str) -> Column:
        by_topic = F.from_json(source[field], TOPIC_OFFSETS)
        if topic is not None:
            return F.try_element_at(by_topic, F.lit(topic))
        return F.get(F.map_values(by_topic), F.lit(0))

    trigger_ms = F.coalesce(F.col("durationMs.triggerExecution"), F.lit(0).cast("long"))
    started = F.col("timestamp").try_cast("timestamp")
    lag = F.coalesce(
        F.try_element_at(source["metrics"], F.lit("maxOffsetsBehindLatest")).try_cast("long"),
        F.lit(0).cast("long"),
    )
    has_source = F.coalesce(F.size("sources") > 0, F.lit(False))
    return log.filter(F.col("event") == "query_progress").select(
        "name",
        F.coalesce("runId", "run_id").alias("run_id"),
        F.coalesce("batchId", F.lit(-1).cast("long")).alias("batch_id"),
        started.alias("started_at"),
        F.timestamp_micros(F.unix_micros(started) + trigger_ms * 1000).alias("completed_at"),
        F.coalesce("numInputRows", F.lit(0).cast("long")).alias("input_rows"),
        F.coalesce("processedRowsPerSecond", F.lit(0.0)).alias("rows_per_second"),
        trigger_ms.alias("trigger_ms"),
        has_source.alias("has_source"),
        F.when(has_source, lag).alias("lag"),
        _sorted_entries(offsets("startOffset")).alias("start_offsets"),
        _sorted_entries(offsets("endOffset")).alias("end_offsets"),
        F.aggregate(
            F.coalesce(F.col("stateOperators.numRowsTotal"), F.array().cast("array<long>")),
            F.lit(0).cast("long"),
            lambda total, n: total + F.coalesce(n, F.lit(0).cast("long")),
        ).alias("state_rows"),
    )
