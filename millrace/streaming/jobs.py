"""Streaming jobs: detection with its side outputs, and a throughput run."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import detect, ingest, slo, trending
from millrace.sinks import lake, published, tables
from millrace.sinks.anomalies import WINDOW_DATE, batches_path
from millrace.streaming.listener import JsonLines

AVAILABLE_NOW = {"availableNow": True}


def with_window_date(anomalies: DataFrame) -> DataFrame:
    """Partition column of the anomaly table.

    It comes from the window's start, which is part of the key: an update of a
    window that crosses midnight stays in its partition.
    """
    return anomalies.withColumn(WINDOW_DATE, F.to_date("window_start"))


@dataclass
class DetectionSettings:
    """Parameters of the job; the defaults are the production values."""

    watermark_minutes: int = 10
    high_frequency_window: str = "10 seconds"
    high_frequency_clicks: int = detect.HIGH_FREQUENCY_CLICKS
    bot_window: str = "1 minute"
    bot_slide: str = "30 seconds"
    bot_clicks: int = detect.BOT_CLICKS
    bot_diversity: float = detect.BOT_DIVERSITY
    dedup_spread: int = 0
    trigger: dict = field(default_factory=lambda: {"processingTime": "5 seconds"})
    late_trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    now: object | None = None


def detections(events: DataFrame, s: DetectionSettings) -> dict[str, DataFrame]:
    """Side outputs and both anomaly streams of one event stream."""
    usable, letters = ingest.unusable(events)
    on_time, late = ingest.split_late(usable, s.watermark_minutes, s.now)
    unique = ingest.drop_duplicate_events(
        on_time, f"{s.watermark_minutes} minutes", spread=s.dedup_spread
    )
    return {
        "dead_letters": letters,
        "late_events": ingest.late_payload(late),
        "high_frequency": detect.detect_high_frequency(
            unique, s.high_frequency_window, s.high_frequency_clicks
        ),
        "bot_like": detect.detect_bot_like(
            unique, s.bot_window, s.bot_slide, s.bot_clicks, s.bot_diversity
        ),
    }


def start_anomalies(
    anomalies: DataFrame,
    name: str,
    sink: Callable[[DataFrame, int], None] | str,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """One named query with its own checkpoint, in update mode.

    Update mode emits a window again whenever it changes, so ``sink`` has to
    replace by key; a row without a score takes the anomaly of its key back. A
    path stands for the versioned Parquet table.
    """
    if isinstance(sink, str):
        path = sink

        def sink(batch: DataFrame, batch_id: int) -> None:
            stamped = ingest.stamp(with_window_date(batch), "db_write_ts")
            tables.append_version(stamped, path, batch_id, WINDOW_DATE)

    return (
        anomalies.writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**trigger)
        .start()
    )


def write_keyed(
    payload: DataFrame,
    name: str,
    checkpoint: str,
    path: str | None = None,
    kafka: tuple[str, str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Key and value rows to Kafka (servers, topic) or to Parquet files."""
    if not kafka and not path:
        raise ValueError("a path or a Kafka topic is needed")
    writer = (
        payload.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if kafka:
        servers, topic = kafka
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .start()
        )
    return writer.format("parquet").option("path", path).start()


def write_late_events(
    payload: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: tuple[str, str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The late side output (:func:`millrace.operators.ingest.late_payload`)."""
    return write_keyed(payload, "late_events", checkpoint, path, kafka, trigger)


def start_ingest(
    raw: DataFrame,
    kind: str,
    lake_root: str,
    dead_letter_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Raw text rows to the event lake, rejects to the dead letters.

    Each micro-batch is parsed once and kept while both parts are written.
    Both outputs are folders named after the batch, so a replay overwrites its
    own rows.
    """
    parse = {"click": ingest.parse_clicks, "purchase": ingest.parse_purchases}[kind]

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch).persist()
        try:
            valid, rejects = ingest.split_valid(parsed)
            lake.write_lake(valid, lake_root, kind, f"ingest_{kind}-{batch_id}")
            letters = ingest.dead_letters(rejects, f"{kind}-loader", kind)
            letters.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    return (
        raw.writeStream.queryName(f"ingest_{kind}")
        .outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/ingest_{kind}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def _start_sketches(
    rows: DataFrame,
    name: str,
    sketch: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    """Sketches of each micro-batch to a published table, each batch once.

    The query keeps no state; late rows add a sketch to their own ``bucket``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        dated = sketch(batch).withColumn("bucket_date", F.to_date("bucket"))
        published.append(dated, path, "bucket_date", name, batch_id)

    return (
        rows.writeStream.queryName(name)
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start_latency_sketches(
    anomalies: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 minute",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Latency sketches (:func:`millrace.operators.slo.latency_sketches`) of a stream."""
    sketch = partial(slo.latency_sketches, width=width)
    return _start_sketches(anomalies, "latency_sketches", sketch, path, checkpoint, trigger)


def start_trending_sketches(
    clicks: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    capacity: int = trending.CAPACITY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Item sketches (:func:`millrace.operators.trending.item_sketches`) of a stream."""
    sketch = partial(trending.item_sketches, width=width, capacity=capacity)
    return _start_sketches(clicks, "trending_sketches", sketch, path, checkpoint, trigger)


def write_console(
    df: DataFrame, name: str, mode: str = "append", rows: int = 50, trigger: dict | None = None
) -> StreamingQuery:
    """Debug output: append for rows, complete for aggregates."""
    return (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .option("numRows", str(rows))
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def start_detection(
    events: DataFrame,
    out: str,
    checkpoint: str,
    settings: DetectionSettings | None = None,
    sinks: dict[str, Callable[[DataFrame, int], None]] | None = None,
    late_kafka: tuple[str, str] | None = None,
) -> dict[str, StreamingQuery]:
    """Start the queries of the job; both detectors write to one anomaly table.

    ``sinks`` replaces the Parquet batches of a detector.
    """
    s = settings or DetectionSettings()
    parts = detections(events, s)
    started = {
        "late_events": write_late_events(
            parts["late_events"],
            checkpoint,
            f"{out}/late_events",
            late_kafka,
            s.late_trigger,
        ),
        "dead_letters": write_keyed(
            parts["dead_letters"],
            "dead_letters",
            checkpoint,
            f"{out}/dead_letters",
            trigger=s.late_trigger,
        ),
    }
    for name in ("high_frequency", "bot_like"):
        sink = (sinks or {}).get(name, batches_path(out, name))
        started[name] = start_anomalies(parts[name], name, sink, checkpoint, s.trigger)
    return started


def run_until_any_stops(spark: SparkSession, queries: dict[str, StreamingQuery]) -> None:
    """Wait until one query ends, then stop them all."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries.values():
            query.stop()


def run_available(queries: dict[str, StreamingQuery]) -> None:
    """Wait for queries started with ``availableNow``; errors are raised."""
    for query in queries.values():
        query.awaitTermination()


# --- throughput ---------------------------------------------------------------


def measured_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that consumes a batch and records rows and ms.

    Rows are counted while the batch is consumed, in one job.
    """
    out = JsonLines(path)

    def consume(batch: DataFrame, batch_id: int) -> None:
        began = time.perf_counter()
        seen = Observation()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.format("noop").mode("overwrite").save()
        out.write(
            {
                "batch_id": batch_id,
                "rows": seen.get["rows"],
                "sink_action_ms": round((time.perf_counter() - began) * 1000, 2),
                "recorded_at_epoch_ms": int(time.time() * 1000),
            }
        )

    return consume


def start_throughput(
    events: DataFrame,
    checkpoint: str,
    batch_log: str,
    deduplicate: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Decode (and optionally deduplicate) into the measured sink."""
    df = ingest.drop_duplicate_events(events) if deduplicate else events
    return (
        df.writeStream.queryName("throughput")
        .outputMode("append")
        .foreachBatch(measured_sink(batch_log))
        .option("checkpointLocation", f"{checkpoint}/throughput")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
