"""Exact interpolated percentiles without gathering a group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here values are counted first (a partial aggregation), laid
out in narrow logarithmic cells, and only the cells that hold a wanted rank are
ordered. A cell spans 1/4096 of a doubling, so a group with a third of all rows
is still spread over many cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.joins import null_safe_join

CELLS_PER_DOUBLING = 4096

# The smallest positive double is 2 to the power of -1074.
SMALLEST_EXPONENT = 1075


def _cell(value: Column) -> Column:
    """Monotone cell number; zero has cell zero and signs mirror."""
    size = F.floor((F.log2(F.abs(value)) + SMALLEST_EXPONENT) * CELLS_PER_DOUBLING)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0).cast("long")


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows (by..., column, probability, percentile, samples), nulls ignored.

    The percentile interpolates linearly between the two nearest ranks.
    """
    by = list(by)
    keys = [*by, "column"]
    long_form = df.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ).alias("entry"),
    ).select(*by, "entry.*")
    counted = (
        long_form.filter(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count("*").alias("n"))
        .withColumn("cell", _cell(F.col("value")))
    )

    # Cells are bounded by the span of the values, not by their number.
    running = Window.partitionBy(*keys).orderBy("cell")
    cells = (
        counted.groupBy(*keys, "cell")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("samples", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    targets = (
        cells.select(*keys, "cell", "before", "upto", "samples", wanted.alias("probability"))
        .withColumn("place", F.col("probability") * (F.col("samples") - 1))
        .withColumn("lower", F.floor("place"))
        .withColumn("upper", F.ceil("place"))
        .filter(
            ((F.col("lower") >= F.col("before")) & (F.col("lower") < F.col("upto")))
            | ((F.col("upper") >= F.col("before")) & (F.col("upper") < F.col("upto")))
        )
    )

    # Order only the values of the cells in question.
    within = Window.partitionBy(*keys, "cell", "probability").orderBy("value")
    placed = (
        null_safe_join(counted, targets.drop("upto"), [*keys, "cell"])
        .withColumn("last", F.col("before") + F.sum("n").over(within))
        .withColumn("first", F.col("last") - F.col("n"))
    )
    holds_lower = (F.col("lower") >= F.col("first")) & (F.col("lower") < F.col("last"))
    holds_upper = (F.col("upper") >= F.col("first")) & (F.col("upper") < F.col("last"))
    return (
        placed.groupBy(*keys, "probability", "place", "lower", "samples")
        .agg(
            F.max(F.when(holds_lower, F.col("value"))).alias("low"),
            F.max(F.when(holds_upper, F.col("value"))).alias("high"),
        )
        .select(
            *keys,
            "probability",
            (
                F.col("low")
                + (F.col("high") - F.col("low")) * (F.col("place") - F.col("lower"))
            ).alias("percentile"),
            "samples",
        )
    )

