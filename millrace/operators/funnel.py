"""Session conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import ratio
from millrace.operators.activity import clicks_in, purchases_in, session_facts


def funnel_sessions(act: DataFrame) -> DataFrame:
    """Per (date, session with clicks): clicks, distinct items, purchases, has_purchase."""
    per_item = act.groupBy("metric_date", "session_id", "item_id").agg(
        clicks_in(act).alias("clicks"), purchases_in(act).alias("purchases")
    )
    viewed = (F.col("clicks") > 0) & F.col("item_id").isNotNull()
    return (
        per_item.groupBy("metric_date", "session_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            F.count_if(viewed).alias("unique_items_viewed"),
            F.sum("purchases").alias("purchase_count"),
        )
        .filter(F.col("click_count") > 0)
        .withColumn("has_purchase", F.col("purchase_count") > 0)
    )


def session_funnel(act: DataFrame) -> DataFrame:
    """VIEW, MULTI_VIEW and PURCHASE per date from one pass over the sessions.

    ``percentage`` is relative to VIEW, ``drop_rate`` to the stage before; a
    drop rate is negative when more sessions buy than view twice.
    """
    clicked = F.col("click_count") > 0
    counts = (
        session_facts(act)
        .groupBy("metric_date")
        .agg(
            F.count_if(clicked).alias("views"),
            F.count_if(F.col("click_count") >= 2).alias("multi"),
            F.count_if(clicked & (F.col("purchase_count") > 0)).alias("buys"),
        )
        .filter(F.col("views") > 0)
    )
    views, multi, buys = F.col("views"), F.col("multi"), F.col("buys")

    def stage(name, count, percentage, drop):
        return F.struct(
            F.lit(name).alias("funnel_stage"),
            count.alias("session_count"),
            percentage.alias("percentage"),
            drop.alias("drop_rate"),
        )

    stages = F.array(
        stage("VIEW", views, F.lit(100.0), F.lit(0.0)),
        stage("MULTI_VIEW", multi, ratio(multi, views) * 100, ratio(views - multi, views)),
        stage("PURCHASE", buys, ratio(buys, views) * 100, ratio(multi - buys, multi)),
    )
    return counts.select("metric_date", F.inline(stages))
