"""Small cleaning and money expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import MONEY


def first_non_empty(df: DataFrame, names: Sequence[str]) -> Column:
    """First of several column variants that is neither null nor empty.

    Variants the frame does not have are skipped; names are matched exactly.
    """
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast("string")
    texts = [F.col(f"`{n}`").cast("string") for n in present]
    return F.coalesce(*[F.when(t != "", t) for t in texts])


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select columns so that each is computed once per row.

    A later filter on a plain projection would be pushed below it and repeat
    the expressions it reads; below a generator it is not.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def normal_category(category: Column) -> Column:
    """'0' and empty mean that the category is missing."""
    return F.when(~category.isin("0", ""), category)


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def line_revenue(price: Column, quantity: Column) -> Column:
    """Exact price x quantity."""
    return money(price) * quantity


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero on a decimal image of the value."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom as double, ``empty`` when the bottom is not positive."""
    quotient = top.cast("double") / bottom.cast("double")
    return F.when(bottom > 0, quotient).otherwise(F.lit(empty).cast("double"))
