"""The anomaly table: one table of both detectors, written by micro-batches.

Every query of the detection job writes its batches below
``anomaly_batches/<query>``; compaction folds them into ``anomaly_sessions``.
Readers see the compacted rows with the batches since then on top. A row without
a score takes back the anomaly of its key; readers do not see it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace import files
from millrace.operators.detect import standing
from millrace.schemas import ANOMALY
from millrace.sinks import published, tables

WINDOW_DATE = "window_date"
ANOMALY_KEYS = ["session_id", "window_start", "anomaly_type"]
TABLE = "anomaly_sessions"
BATCHES = "anomaly_batches"


def stored_schema() -> T.StructType:
    """Anomaly columns plus the write time and the partition column."""
    extra = [T.StructField("db_write_ts", T.TimestampType()), T.StructField(WINDOW_DATE, T.DateType())]
    return T.StructType([*ANOMALY.fields, *extra])


def batches_path(root: str, query: str) -> str:
    return f"{root.rstrip('/')}/{BATCHES}/{query}"


def _queries(spark: SparkSession, root: str) -> list[str]:
    return sorted(files.folders(spark, f"{root.rstrip('/')}/{BATCHES}"))


def anomaly_table_exists(spark: SparkSession, root: str) -> bool:
    return bool(_queries(spark, root)) or files.exists(spark, f"{root.rstrip('/')}/{TABLE}")


def read_anomaly_table(spark: SparkSession, root: str) -> DataFrame:
    """Current rows of all queries of the job that writes below ``root``.

    The type is part of the key, so rows of two queries never replace each other.
    """
    schema = stored_schema()
    current = published.read(spark, f"{root.rstrip('/')}/{TABLE}", schema)
    for query in _queries(spark, root):
        newest = tables.latest_version(
            spark, batches_path(root, query), ANOMALY_KEYS, schema, WINDOW_DATE
        )
        current = tables.merge(current, newest.select(*schema.fieldNames()), ANOMALY_KEYS)
    return standing(current)


def compact_anomalies(spark: SparkSession, root: str) -> None:
    """Fold the finished batches of every query into the plain table."""
    for query in _queries(spark, root):
        path = batches_path(root, query)
        done = [
            int(name.split("=", 1)[1])
            for name in files.folders(spark, path)
            if name.startswith("batch_id=") and files.exists(spark, f"{path}/{name}/_SUCCESS")
        ]
        if done:
            tables.compact(
                spark,
                path,
                f"{root.rstrip('/')}/{TABLE}",
                ANOMALY_KEYS,
                stored_schema(),
                WINDOW_DATE,
                max(done),
            )
