"""Popular items and categories, ranked per date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import line_revenue, ratio
from millrace.operators.activity import clicks_in, purchases_in

MONEY_TOTAL = "decimal(23,2)"


def clicks_per_item(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("metric_date", "item_id").agg(F.count("*").alias("click_count"))


def purchases_per_item(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("metric_date", "item_id").agg(
        F.count("*").alias("purchase_count"),
        F.sum(line_revenue(F.col("price"), F.col("quantity"))).alias("revenue"),
    )


def item_categories(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, item, category)."""
    return clicks.groupBy("metric_date", "item_id", "category").agg(F.count("*").alias("n"))


def _preferred(n: Column) -> Column:
    """Sort key of the primary category: most clicks, then name, null last."""
    category = F.col("category")
    return F.struct((-n).alias("n"), category.isNull().alias("missing"), category.alias("name"))


def primary_category(clicks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per key, the category with most clicks; ties go to the smaller name.

    ``min_by`` keeps one candidate per key while aggregating, where a ranked
    window would sort every candidate.
    """
    by = by or ["metric_date", "item_id"]
    counts = clicks.groupBy(*by, "category").agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(
        F.min_by("category", _preferred(F.col("n"))).alias("category"),
        F.min_by("n", _preferred(F.col("n"))).alias("category_clicks"),
    )


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group with their rank.

    Rows are ranked in slices first, one for each task that made them, so no
    task orders a whole group; the firsts of the slices are ranked again. For
    small ``n`` Spark drops rows beyond the rank bound before either shuffle.
    """

    def ranked(frame: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return frame.withColumn("rank", place.cast("int")).filter(F.col("rank") <= n)

    sliced = ranked(df.withColumn("_slice", F.spark_partition_id()), [*by, "_slice"])
    return ranked(sliced.drop("rank", "_slice"), list(by))


def item_stats(act: DataFrame) -> DataFrame:
    """Per (date, clicked item): primary category, clicks, purchases, revenue."""
    per_category = act.groupBy("metric_date", "item_id", "category").agg(
        clicks_in(act).alias("clicks"),
        purchases_in(act).alias("purchases"),
        F.sum("revenue").alias("revenue"),
    )
    clicked = F.col("clicks") > 0
    return (
        per_category.groupBy("metric_date", "item_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            F.min_by(
                "category", F.when(clicked, _preferred(F.col("clicks")))
            ).alias("category"),
            F.sum("purchases").alias("purchase_count"),
            F.coalesce(F.sum("revenue"), F.lit(0)).cast(MONEY_TOTAL).alias("revenue"),
        )
        .filter(F.col("click_count") > 0)
    )


def popular_items(act: DataFrame, n: int = 100) -> DataFrame:
    """Top ``n`` items per date by revenue, item id breaking ties."""
    ranked = top_n(
        item_stats(act), ["metric_date"], [F.col("revenue").desc(), F.col("item_id").asc()], n
    )
    return ranked.select(
        "metric_date",
        "item_id",
        "category",
        "click_count",
        "purchase_count",
        F.col("revenue").cast("decimal(15,2)").alias("revenue"),
        "rank",
        ratio(F.col("click_count"), F.col("purchase_count"), None).alias(
            "click_to_purchase_ratio"
        ),
    )


def category_clicks(clicks: DataFrame) -> DataFrame:
    """Per (date, category): clicks and distinct items; no row for a missing category."""
    return _category_clicks(item_categories(clicks.filter(F.col("category").isNotNull())))


def _category_clicks(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("metric_date", "category").agg(
        F.sum("n").alias("click_count"), F.count("item_id").alias("unique_items")
    )


def category_purchases(
    clicks: DataFrame, purchases: DataFrame, attribution: str = "all"
) -> DataFrame:
    """Per (date, category): purchases and revenue of the items clicked in it.

    ``all`` credits a purchase to each category the item was clicked in that
    day, ``primary`` to its primary category only. Purchases are summed per
    item first, so the fan-out multiplies items and not purchase rows.
    """
    return _category_purchases(_item_category_pairs(clicks, attribution), purchases)


def _item_category_pairs(clicks: DataFrame, attribution: str) -> DataFrame:
    if attribution == "all":
        pairs = item_categories(clicks)
    elif attribution == "primary":
        pairs = primary_category(clicks)
    else:
        raise ValueError(f"unknown attribution: {attribution}")
    return pairs.filter(F.col("category").isNotNull())


def _category_purchases(pairs: DataFrame, purchases: DataFrame) -> DataFrame:
    sold = purchases_per_item(purchases)
    return (
        pairs.join(sold, ["metric_date", "item_id"])
        .groupBy("metric_date", "category")
        .agg(
            F.sum("purchase_count").alias("purchase_count"),
            F.sum("revenue").alias("revenue"),
        )
    )


def category_stats(
    clicks: DataFrame, purchases: DataFrame, attribution: str = "all"
) -> DataFrame:
    """Clicks, distinct items, purchases and revenue per (date, category)."""
    if attribution == "all":
        # One join on (date, item) feeds all four figures.
        pairs = _item_category_pairs(clicks, attribution)
        joined = pairs.join(purchases_per_item(purchases), ["metric_date", "item_id"], "left")
        stats = joined.groupBy("metric_date", "category").agg(
            F.sum("n").alias("click_count"),
            F.count("item_id").alias("unique_items"),
            F.sum("purchase_count").alias("purchase_count"),
            F.sum("revenue").alias("revenue"),
        )
    else:
        stats = category_clicks(clicks).join(
            category_purchases(clicks, purchases, attribution),
            ["metric_date", "category"],
            "left",
        )
    return stats.withColumn(
        "purchase_count", F.coalesce("purchase_count", F.lit(0).cast("long"))
    ).withColumn("revenue", F.coalesce("revenue", F.lit(0)).cast(MONEY_TOTAL))


def activity_category_stats(act: DataFrame) -> DataFrame:
    """:func:`category_stats` of both kinds in one frame, from one scan.

    Rows shrink to (date, item, category) first. The purchases of an item, which
    have no category, are added up over its few rows and credited to each
    category it was clicked in.
    """
    digest = act.groupBy("metric_date", "item_id", "category").agg(
        clicks_in(act).alias("n"),
        purchases_in(act).alias("bought"),
        F.sum("revenue").alias("paid"),
    )
    item = Window.partitionBy("metric_date", "item_id")
    known = F.col("item_id").isNotNull()
    return (
        digest.withColumns(
            {
                "bought": F.when(known, F.sum("bought").over(item)).otherwise(0),
                "paid": F.when(known, F.sum("paid").over(item)),
            }
        )
        .filter((F.col("n") > 0) & F.col("category").isNotNull())
        .groupBy("metric_date", "category")
        .agg(
            F.sum("n").alias("click_count"),
            F.count("item_id").alias("unique_items"),
            F.sum("bought").alias("purchase_count"),
            F.coalesce(F.sum("paid"), F.lit(0)).cast(MONEY_TOTAL).alias("revenue"),
        )
    )


def popular_categories(
    clicks: DataFrame, purchases: DataFrame, n: int = 20, attribution: str = "all"
) -> DataFrame:
    """Top ``n`` categories per date by revenue, the name breaking ties."""
    return top_categories(category_stats(clicks, purchases, attribution), n)


def top_categories(stats: DataFrame, n: int = 20) -> DataFrame:
    """The ranked form of category statistics."""
    order = [F.col("revenue").desc(), F.col("category").asc()]
    ranked = top_n(stats, ["metric_date"], order, n)
    return ranked.select(
        "metric_date",
        "category",
        "click_count",
        "purchase_count",
        "unique_items",
        F.col("revenue").cast("decimal(15,2)").alias("revenue"),
        "rank",
    )
