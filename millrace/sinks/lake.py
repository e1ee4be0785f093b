"""Event lake writer: snappy Parquet by event day and hour in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import times


def with_partitions(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    moment = times.event_time(df, ts)
    return df.withColumn("dt", F.to_date(moment)).withColumn("hour", F.hour(moment))


def write_lake(df: DataFrame, root: str, kind: str, batch: str) -> None:
    """Write one kind of event below ``root``, in folders (dt, hour, batch).

    Loads and streams share this layout. ``batch`` names the load: the dynamic overwrite replaces what an
    earlier attempt of the same ``batch`` wrote, and nothing else.

    The rebalance hint gathers each hour into few files, and lets adaptive
    execution cut an hour that holds far more rows than the others into
    several tasks.
    """
    (
        with_partitions(df)
        .withColumn("batch", F.lit(batch))
        .hint("rebalance", "dt", "hour")
        .write.partitionBy("dt", "hour", "batch")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(f"{root.rstrip('/')}/{kind}")
    )


def stream_to_lake(
    df: DataFrame, root: str, kind: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same as a stream; a replayed micro-batch overwrites its own rows."""
    name = f"lake_{kind}"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_lake(batch, root, kind, f"{name}-{batch_id}")

    return (
        df.writeStream.queryName(name)
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
        .start()
    )


def write_sorted(df: DataFrame, ts: str, path: str, fmt: str = "parquet") -> None:
    """Total order by time over all output files.

    The other columns follow the time in the sort key, so that many rows with
    one and the same time can still be cut into several ranges.
    """
    sorted_by_time(df, ts).write.mode("overwrite").option("header", True).format(fmt).save(path)


def sorted_by_time(df: DataFrame, ts: str = "event_ts", *ties: str) -> DataFrame:
    rest = list(ties) or [c for c in df.columns if c != ts]
    return df.orderBy(ts, *rest)
