"""Headline timings; prints one JSON line.

Batch queries run over the whole tables into a no-op sink. The streaming
figures are one ``availableNow`` run of a production operator (default windows
and thresholds) over the events table from files, without a message broker
and a database: rows per second and trigger time of the micro-batch as Spark
reports them, and the rows left in the state store.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import detect, ingest
from millrace.plans.registered import QUERIES
from millrace.session import build_session, work_path
from millrace.sources import event_table as et
from millrace.streaming import jobs

BATCH = [
    "daily_metrics",
    "popular_items",
    "popular_categories",
    "session_funnel",
    "session_summary",
    "detect_high_frequency",
    "detect_bot_like",
    "valid_events",
    "dead_letters",
    "repaired_events",
    "late_payload",
    "sorted_events",
    "anomaly_types",
    "trending_items",
    "quality_checks",
    "slo_latency",
    "progress_summary",
    "offset_continuity",
    "replace_date_roundtrip",
    "upsert_roundtrip",
]
ROUNDS = 3

# Run for comparison only: deduplication whose state is never evicted.
COMPARED = {"stream_dedup_unbounded"}


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed_batch(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Best of a few runs; the first one also pays for code generation."""
    times = []
    for _ in range(ROUNDS):
        begun = time.perf_counter()
        consume(QUERIES[name](spark, sf_dir))
        times.append(time.perf_counter() - begun)
    return min(times)


def clicks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in the shape of decoded click records."""
    from pyspark.sql import functions as F

    events = et.as_events(et.stream_raw(spark, sf_dir))
    return events.select(
        F.col("eid").cast("string").alias("event_id"),
        "session_id",
        "item_id",
        "event_ts",
        F.col("event_ts").alias("kafka_ingest_ts"),
    )


def streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    clicks = clicks_stream(spark, sf_dir)
    unique = ingest.drop_duplicate_events(clicks, "10 minutes")
    unbounded = clicks.withWatermark("event_ts", "10 minutes").dropDuplicates(["event_id"])
    return {
        "stream_decode": clicks,
        "stream_dedup": unique,
        "stream_dedup_unbounded": unbounded,
        "stream_high_frequency": detect.detect_high_frequency(unique),
        "stream_bot_like": detect.detect_bot_like(unique),
    }


def timed_stream(df: DataFrame, name: str) -> dict[str, float]:
    out = work_path(df.sparkSession, f"bench_{name}")
    begun = time.perf_counter()
    started = (
        df.writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(lambda batch, _: consume(batch))
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**jobs.AVAILABLE_NOW)
        .start()
    )
    jobs.run_available({name: started})
    seconds = time.perf_counter() - begun
    progress = [json.loads(p.json) for p in started.recentProgress]
    rows = sum(p["numInputRows"] for p in progress)
    busiest = max(progress, key=lambda p: p["numInputRows"])
    return {
        "seconds": seconds,
        "rows": rows,
        "rows_per_second": rows * 1000 / busiest["durationMs"]["triggerExecution"],
        "trigger_ms": busiest["durationMs"]["triggerExecution"],
        "state_rows": sum(s["numRowsTotal"] for s in progress[-1]["stateOperators"]),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        state_memory_mb=2048,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    consume(QUERIES[BATCH[0]](spark, sf_dir))
    seconds: dict[str, float] = {}
    for name in BATCH:
        seconds[name] = round(timed_batch(spark, name, sf_dir), 3)
    streaming: dict[str, dict[str, float]] = {}
    for name, df in streams(spark, sf_dir).items():
        runs = [timed_stream(df, name) for _ in range(ROUNDS)]
        best = min(runs, key=lambda r: r["seconds"])
        if name not in COMPARED:
            seconds[name] = round(best["seconds"], 3)
        streaming[name] = {k: round(v, 1) for k, v in best.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "streaming": streaming,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
