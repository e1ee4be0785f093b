"""Raw CSV files with a header. Columns stay text; parsing is in ingest.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace import schemas as S
from millrace.operators.ingest import parse_clicks, parse_purchases


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All columns as strings. Without ``schema`` the header names the columns."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_click_csv(spark: SparkSession, path: str, **kwargs: object) -> DataFrame:
    """Parsed clicks with an ``error`` column; header variants are accepted."""
    return parse_clicks(read_raw_csv(spark, path), **kwargs)


def read_purchase_csv(spark: SparkSession, path: str, **kwargs: object) -> DataFrame:
    return parse_purchases(read_raw_csv(spark, path, S.PURCHASE_CSV), **kwargs)
