"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import work_path

#: Rows that one Arrow batch carries to a Python worker. Whole texts travel, so
#: the default of ten thousand would need too much memory for long documents.
ROWS_PER_BATCH = 500

#: Regular expression of the white space that separates words (ASCII only).
WHITE = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small in this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bundled table."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_in_files(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Cuts the lineage: a lost executor costs one read, not a recomputation, and
    values such as row numbers no longer change.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, *columns: Column | str) -> DataFrame:
    """``columns`` with a fixed unique ``row_no`` for each row, kept in files.

    Document ids may repeat or be null, so operators that join rows to
    themselves go by this number.
    """
    return kept_in_files(
        df.select(F.monotonically_increasing_id().alias("row_no"), *columns), name
    )


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
