"""Hourly sums of activity, and sketches of them that merge over any range.

A partial row is what one hour adds to a (date, session, item, category). The
sums are additive and the first and last click merge, so the daily reports come
out the same from partial rows as from events, and an hour that changes is
computed again alone.

Distinct counts do not add up over dates. :func:`hour_sketches` keeps a
HyperLogLog sketch for each hour, :func:`over_range` merges those of a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.activity import clicks_in, is_click, purchases_in

HOUR_MS = 3_600_000

#: A sketch has 2 ** SKETCH_BITS registers of a byte.
SKETCH_BITS = 12

#: Three standard errors of a merged sketch, relative to the count.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)

PARTIAL = T.StructType(
    [
        T.StructField("slot", T.StringType()),
        T.StructField("metric_date", T.DateType()),
        T.StructField("session_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("first_click_ms", T.LongType()),
        T.StructField("last_click_ms", T.LongType()),
        T.StructField("revenue", T.DecimalType(33, 2)),
    ]
)


def _hour(ms: Column) -> Column:
    return F.pmod(F.floor(ms / HOUR_MS), F.lit(24))


def slot_of(day: Column, ms: Column) -> Column:
    """Text like ``2024-01-15T07``."""
    return F.concat_ws("T", day.cast("string"), F.lpad(_hour(ms).cast("string"), 2, "0"))


def partials(act: DataFrame) -> DataFrame:
    """One row per (hour, session, item, category) of activity rows; a task sums
    its own rows first, so a hot item does not put its events in one task."""
    slot = slot_of(F.col("metric_date"), F.col("event_ms"))
    click_ms = F.when(is_click(), F.col("event_ms"))
    keys = ["slot", "metric_date", "session_id", "item_id", "category"]
    found = act.withColumn("slot", slot).groupBy(*keys).agg(
        clicks_in(act).alias("clicks"),
        purchases_in(act).alias("purchases"),
        F.min(click_ms).alias("first_click_ms"),
        F.max(click_ms).alias("last_click_ms"),
        F.sum("revenue").alias("revenue"),
    )
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTIAL])


def hour_sketches(rows: DataFrame) -> DataFrame:
    """Per (date, hour) of partial rows: sums, and sketches of the sessions that
    click, the sessions that buy and the items clicked. Nulls are not counted."""

    def sketch(column: str, where: Column) -> Column:
        return F.hll_sketch_agg(F.when(where, F.col(column)), SKETCH_BITS)

    clicked, bought = F.col("clicks") > 0, F.col("purchases") > 0
    return rows.groupBy("metric_date", F.substring("slot", 12, 2).cast("int").alias("hour")).agg(
        clicks_in(rows).alias("click_count"),
        purchases_in(rows).alias("purchase_count"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(23,2)").alias("revenue"),
        sketch("session_id", clicked).alias("session_sketch"),
        sketch("session_id", bought).alias("buyer_sketch"),
        sketch("item_id", clicked).alias("item_sketch"),
    )


def over_range(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Sums and distinct counts of the hours in each group (one group without ``by``).

    A distinct count is off by more than ``SKETCH_ERROR`` of itself in about three
    of a thousand cases, and exact for small groups. Only sketches are read: the
    work does not grow with the events, and hours may be grouped in any way.
    """

    def count(column: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(column))

    return sketches.groupBy(*by).agg(
        F.sum("click_count").alias("total_clicks"),
        F.sum("purchase_count").alias("total_purchases"),
        F.sum("revenue").cast("decimal(23,2)").alias("total_revenue"),
        count("session_sketch").alias("unique_sessions"),
        count("buyer_sketch").alias("purchase_sessions"),
        count("item_sketch").alias("unique_items"),
    )
