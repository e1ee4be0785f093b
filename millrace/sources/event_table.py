"""Clickstream frames over the bundled ``events`` table.

``events`` has no sessions, items or categories of its own; they are derived
column by column, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import files
from millrace.functions.values import money

RAW_COLUMNS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream.

    A stream reads folders: a table of part files is read as it is, a lone file
    by its name in the folder above.
    """
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(RAW_COLUMNS)
    if files.is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def as_events(raw: DataFrame) -> DataFrame:
    """eid, event_ts, event_ms, user, session, item, type, price, quantity, date."""
    ts = F.col("ts").cast("timestamp")
    item = F.get_json_object("props", "$.k").cast("long")
    return raw.select(
        F.col("event_id").alias("eid"),
        ts.alias("event_ts"),
        F.unix_millis(ts).alias("event_ms"),
        "user_id",
        (F.col("user_id") * 1000 + F.dayofyear(ts)).alias("session_id"),
        item.alias("item_id"),
        "event_type",
        money(F.col("value")).alias("price"),
        (1 + F.col("event_id") % 3).cast("int").alias("quantity"),
        F.to_date(ts).alias("metric_date"),
    )


def with_category(events: DataFrame) -> DataFrame:
    """Category domain: missing, special offer 'S', or a number as text."""
    code = (F.col("item_id") * 7 + F.col("eid")) % 13
    return events.withColumn(
        "category", F.when(code == 12, F.lit("S")).when(code != 0, code.cast("string"))
    )


def clicks_of(events: DataFrame) -> DataFrame:
    return with_category(events.filter(F.col("event_type").isin("click", "view")))


def purchases_of(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(read_raw(spark, sf_dir))


def read_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_of(read_events(spark, sf_dir))


def read_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_of(read_events(spark, sf_dir))


def read_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases as one frame from a single scan (see activity.py)."""
    from millrace.operators.activity import activity_from_events

    shopping = F.col("event_type").isin("click", "view", "purchase")
    events = with_category(read_events(spark, sf_dir).filter(shopping))
    kind = F.when(F.col("event_type") == "purchase", "purchase").otherwise("click")
    return activity_from_events(events.withColumn("kind", kind))


def detection_events(events: DataFrame) -> DataFrame:
    """All events of a user as one session, the event type as the item.

    ``events`` is sparse in time; this gives windows with several hits.
    """
    return events.select(
        F.col("eid").cast("string").alias("event_id"),
        F.col("user_id").alias("session_id"),
        F.col("event_type").alias("item_id"),
        "event_ts",
        (F.col("event_ts") + F.expr("make_dt_interval(0, 0, 0, (eid % 700) / 1000)")).alias(
            "kafka_ingest_ts"
        ),
    )
