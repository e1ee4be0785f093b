"""Result tables as DataFrames, from Parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace import files
from millrace import schemas as S
from millrace.sinks import published
from millrace.sinks.anomalies import TABLE, anomaly_table_exists, read_anomaly_table
from millrace.sources.lake import read_or_empty

TABLES: dict[str, T.StructType] = {
    "anomaly_sessions": S.ANOMALY,
    "daily_metrics": S.DAILY_METRICS,
    "session_funnel": S.SESSION_FUNNEL,
    "popular_items": S.POPULAR_ITEMS,
    "popular_categories": S.POPULAR_CATEGORIES,
    "session_summary": S.SESSION_SUMMARY,
    "data_quality_checks": S.QUALITY_CHECKS,
    "pipeline_runs": S.PIPELINE_RUNS,
    "alert_history": S.ALERT_HISTORY,
}


def read_table(
    spark: SparkSession, root: str, name: str, missing_ok: bool = False
) -> DataFrame:
    """A table below ``root``. One that was never written is an error, or empty
    if ``missing_ok``; the anomaly table is read with its newest batches."""
    path = f"{root.rstrip('/')}/{name}"
    anomalies = name == TABLE
    if not missing_ok:
        found = anomaly_table_exists(spark, root) if anomalies else files.exists(spark, path)
        if not found:
            raise FileNotFoundError(f"no table {name} below {root}")
    if anomalies:
        return read_anomaly_table(spark, root)
    if published.exists(spark, path):
        empty = not published.version(spark, path).folders
        return published.read(spark, path, TABLES[name] if empty else None)
    return read_or_empty(spark, path, TABLES[name], infer=True)


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    split: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """A table over JDBC; ``split`` = (column, lower, upper, partitions) reads in parallel."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split:
        column, lower, upper, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
    return reader.load()
