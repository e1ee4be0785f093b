"""Idempotent writers for result tables kept as partitioned Parquet.

* ``replace_date`` / ``replace_dates`` swap whole dates.
* ``upsert`` merges rows by key into the touched partitions.

Both publish a version of the table in one step (:mod:`millrace.sinks.published`).

* ``append_version`` / ``current_rows`` keep one folder per micro-batch and
  pick the newest row of a key when reading; a replayed batch overwrites its
  own folder only. ``compact`` folds the versions into a plain table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.functions.joins import null_safe_join
from millrace.functions.times import parse_date
from millrace.sinks import published
from millrace.sources.lake import read_or_empty


def replace_dates(
    df: DataFrame,
    path: str,
    partition: str = "metric_date",
    days: Iterable[str | dt.date] | None = None,
    coalesce: int | None = None,
    marks: dict[str, str] | None = None,
) -> int:
    """Replace whole dates of a published table; returns the rows written.

    With ``days``, exactly these are replaced: rows of other dates are left out,
    and a day without rows ends up empty. Without, every date that ``df`` has
    rows for. Rows are written once; all dates change in one step. ``marks`` say
    what a folder was computed from.
    """
    wanted = None if days is None else sorted({parse_date(day) for day in days})
    if wanted is not None:
        df = df.filter(F.col(partition).isin(wanted))
    folders = [f"{partition}={day.isoformat()}" for day in wanted or ()]
    return published.replace(df, path, partition, folders, coalesce, marks=marks)


def replace_date(
    df: DataFrame,
    path: str,
    date: str | dt.date,
    partition: str = "metric_date",
    coalesce: int | None = None,
) -> int:
    """:func:`replace_dates` of one date."""
    return replace_dates(df, path, partition, [date], coalesce)


def _touched(existing: DataFrame, changes: DataFrame, partition: str) -> DataFrame:
    """Existing rows of the partitions that ``changes`` has rows for, null among them."""
    return null_safe_join(existing, changes.select(partition).distinct(), [partition], "left_semi")


def merge(existing: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changes`` (one row per key) win over ``existing`` rows of the same key.

    Keys are equal if their nulls are, too.
    """
    kept = null_safe_join(existing, changes.select(*keys), keys, "left_anti")
    return kept.select(*changes.columns).unionByName(changes)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``order``, or any if no order is given."""
    if not order:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def upsert(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    batch: str,
    order: Sequence[str] = (),
) -> None:
    """Merge ``changes`` into the published table at ``path`` by key.

    ``partition`` must be a function of the key, so a key never moves between
    partitions. The changes are computed once, into a side folder named after
    ``batch``. Touched partitions are written in full and change in one step; if
    another writer changed one of them meanwhile, they are merged again.
    """
    spark = changes.sparkSession
    side = f"{path.rstrip('/')}/staging/{batch}"
    one_per_key(changes, keys, order).write.mode("overwrite").parquet(side)
    newest = spark.read.schema(changes.schema).parquet(side)
    for attempt in range(published.ATTEMPTS):
        base = published.version(spark, path)
        existing = published.read(spark, path, changes.schema, number=base.number)
        merged = merge(_touched(existing, newest, partition), newest, keys)
        try:
            published.replace(merged, path, partition, base=base)
            break
        except published.Changed:
            if attempt == published.ATTEMPTS - 1:
                raise
    files.delete(spark, side)


def append_version(batch: DataFrame, path: str, batch_id: int, partition: str) -> None:
    """Write one micro-batch to its own folder; a replay overwrites it."""
    (
        batch.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    )


def _versions(spark: SparkSession, path: str, schema: T.StructType, partition: str) -> DataFrame:
    fields = sorted(schema.fields, key=lambda f: f.name == partition)
    layout = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
    return read_or_empty(spark, path, layout)


def latest_version(
    spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, partition: str
) -> DataFrame:
    """Newest row per key over all micro-batches."""
    versions = _versions(spark, path, schema, partition)
    return one_per_key(versions, keys, ["batch_id"]).drop("batch_id")


def current_rows(
    spark: SparkSession,
    path: str,
    target: str,
    keys: Sequence[str],
    schema: T.StructType,
    partition: str,
) -> DataFrame:
    """Rows of the compacted table, with micro-batches since then on top."""
    newest = latest_version(spark, path, keys, schema, partition)
    return merge(published.read(spark, target, newest.schema), newest, keys)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    keys: Sequence[str],
    schema: T.StructType,
    partition: str,
    upto: int,
) -> None:
    """Fold micro-batches up to ``upto`` into ``target`` and delete their folders.

    The oldest folders go first: if a run dies half way, what is left is newer
    than, or equal to, what the target holds, and the next run repeats it.
    """
    versions = _versions(spark, path, schema, partition).filter(F.col("batch_id") <= upto)
    newest = one_per_key(versions, keys, ["batch_id"]).drop("batch_id")
    upsert(newest, target, keys, partition, f"compact-{upto}")
    numbers = [
        int(name.split("=", 1)[1])
        for name in files.folders(spark, path)
        if name.startswith("batch_id=")
    ]
    for number in sorted(n for n in numbers if n <= upto):
        files.delete(spark, f"{path.rstrip('/')}/batch_id={number}")


def drop_expired_partitions(
    spark: SparkSession, path: str, partition: str, as_of: str | dt.date, days: int = 30
) -> DataFrame:
    """Take dates older than ``as_of - days`` out of a published table; reports each.

    Works on folder names only. A name that is not a date is reported and kept.
    Their files go with :func:`millrace.sinks.published.vacuum`.
    """
    cutoff = parse_date(as_of) - dt.timedelta(days=days)

    def day_of(folder: str) -> dt.date | None:
        try:
            return parse_date(folder.split("=", 1)[1])
        except ValueError:
            return None

    before = published.version(spark, path).folders
    gone = published.drop(spark, path, lambda f: (day := day_of(f)) is not None and day < cutoff)
    report = [
        (f, day_of(f), "DROPPED" if f in gone else "UNREADABLE" if day_of(f) is None else "KEPT")
        for f in sorted({*before, *gone})
    ]
    return spark.createDataFrame(report, "folder string, partition_date date, action string")


def drop_expired_catalog_partitions(
    spark: SparkSession, table: str, partition: str, as_of: str | dt.date, days: int = 30
) -> None:
    """The same for a catalogue table partitioned by one date column.

    Spark drops partitions by equality only, so the expired ones are named.
    """
    cutoff = parse_date(as_of) - dt.timedelta(days=days)
    names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    for day in sorted(name.split("=", 1)[1] for name in names):
        if day < cutoff.isoformat():
            spark.sql(
                f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = DATE'{day}')"
            )
