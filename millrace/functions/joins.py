"""Join on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join where null matches null; the key columns are the left ones."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*[f"_{k}" for k in keys])
