"""Latency report over stored anomalies, in milliseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.functions.percentiles import exact_percentiles

#: Size of a latency sketch, and a bound of its rank error: more than twice the
#: 1.33 % that a sketch of this size keeps with 99 % confidence.
SKETCH_K = 200
RANK_ERROR = 0.03

STAGES = ["produce_to_kafka_ms", "kafka_to_spark_ms", "spark_to_db_ms", "e2e_ms"]


def _ms(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)).cast("double") / 1000


def _complete() -> Column:
    """Rows with all times; needs kafka_ingest_ts, spark_process_ts, db_write_ts."""
    return (
        F.col("kafka_ingest_ts").isNotNull()
        & F.col("spark_process_ts").isNotNull()
        & F.col("db_write_ts").isNotNull()
    )


def _stages() -> list[Column]:
    """Latency of each stage; needs event_ts (epoch ms) as well."""
    produced = F.timestamp_millis("event_ts")
    return [
        _ms(F.col("kafka_ingest_ts"), produced).alias(STAGES[0]),
        _ms(F.col("spark_process_ts"), F.col("kafka_ingest_ts")).alias(STAGES[1]),
        _ms(F.col("db_write_ts"), F.col("spark_process_ts")).alias(STAGES[2]),
        _ms(F.col("db_write_ts"), produced).alias(STAGES[3]),
    ]


def stage_latencies(anomalies: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """Latency of each stage for rows detected within the look-back."""
    recent = times.last_hours(F.col("detected_at"), as_of, hours)
    return anomalies.filter(recent & _complete()).select(*_stages())


def latency_sketches(anomalies: DataFrame, width: str = "1 minute") -> DataFrame:
    """A KLL sketch of every stage's latencies for each ``width`` of detection time.

    A sketch has a few hundred values however many rows it stands for. Tasks
    sketch their own rows first, and sketches of the same minute from different
    batches are merged when they are read.
    """
    start = F.window("detected_at", width)["start"].alias("bucket")
    latencies = anomalies.filter(_complete()).select(start, *_stages())
    return latencies.groupBy("bucket").agg(
        *[F.kll_sketch_agg_double(stage, SKETCH_K).alias(stage) for stage in STAGES]
    )


def sketched_latency(
    sketches: DataFrame, *by: Column | str, probabilities: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Samples and percentiles of every stage over the sketches of each group.

    The share of rows below a percentile is off by less than ``RANK_ERROR``.
    """
    merged = sketches.groupBy(*by).agg(
        *[F.kll_merge_agg_double(stage).alias(f"_{stage}") for stage in STAGES]
    )
    found = [
        F.kll_sketch_get_quantile_double(f"_{stage}", F.lit(p)).alias(f"p{round(p * 100)}_{stage}")
        for stage in STAGES
        for p in probabilities
    ]
    samples = F.kll_sketch_get_n_double(f"_{STAGES[3]}").alias("samples")
    return merged.select(*merged.columns[: len(by)], samples, *found)


def slo_latency(anomalies: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """One row: samples, p50 of every stage, p95 and p99 end to end."""
    latencies = stage_latencies(anomalies, as_of, hours)
    found = exact_percentiles(latencies, STAGES, [0.5, 0.95, 0.99])

    def pick(stage: str, p: float) -> Column:
        here = (F.col("column") == stage) & (F.col("probability") == p)
        return F.max(F.when(here, F.col("percentile"))).alias(f"p{round(p * 100)}_{stage}")

    samples = F.max(F.when(F.col("column") == "e2e_ms", F.col("samples")))
    return found.agg(
        F.coalesce(samples, F.lit(0).cast("long")).alias("samples"),
        *[pick(stage, 0.5) for stage in STAGES],
        pick("e2e_ms", 0.95),
        pick("e2e_ms", 0.99),
    )


def slo_report(anomalies: DataFrame, as_of: object, hours: int = 24) -> DataFrame:
    """The same as one JSON document."""
    report = slo_latency(anomalies, as_of, hours)
    return report.select(
        F.to_json(
            F.struct(
                times.as_column(as_of).cast("timestamp").alias("generated_at"),
                F.lit(hours).alias("window_hours"),
                F.struct(*report.columns).alias("report"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("report")
    )
