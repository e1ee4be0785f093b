"""Event lake: Parquet under dt=YYYY-MM-DD/hour=H/batch=NAME."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files
from millrace.functions.times import between_dates, parse_date
from millrace.schemas import EVENT_SCHEMAS

# Conditions Spark raises for a path that is absent or has no files.
MISSING_PATH = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, infer: bool = False
) -> DataFrame:
    """The Parquet data, or an empty typed frame when nothing is there.

    Any other failure (access, corrupt files) is raised.
    """
    if not files.matches(spark, path):
        return spark.createDataFrame([], schema)
    try:
        reader = spark.read if infer else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in MISSING_PATH:
            return spark.createDataFrame([], schema)
        raise


def lake_schema(kind: str) -> T.StructType:
    """Event columns plus the partition columns."""
    columns = [*EVENT_SCHEMAS[kind].fields]
    return T.StructType(
        [
            *columns,
            T.StructField("dt", T.DateType()),
            T.StructField("hour", T.IntegerType()),
            T.StructField("batch", T.StringType()),
        ]
    )


def read_events(
    spark: SparkSession,
    root: str,
    kind: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """One kind of event, one day or an inclusive range of days.

    Only the folders of the wanted days are listed and scanned; the root stays
    the base path, so ``dt`` and ``hour`` remain columns.
    """
    base = f"{root.rstrip('/')}/{kind}"
    schema = lake_schema(kind)
    if start is None:
        return read_or_empty(spark, base, schema).drop("batch")
    first = parse_date(start)
    last = parse_date(end) if end is not None else first
    wanted = between_dates(F.col("dt"), first, last)
    days = [
        name
        for name in files.folders(spark, base)
        if f"dt={first.isoformat()}" <= name <= f"dt={last.isoformat()}"
    ]
    if not days:
        return spark.createDataFrame([], schema).drop("batch")
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/{day}" for day in days]).filter(wanted).drop("batch")


def hour_marks(
    spark: SparkSession, root: str, kind: str, first: dt.date, last: dt.date
) -> dict[str, str]:
    """A digest of the files of each hour of a range of days, by ``2024-01-15T07``.

    Spark lists the folders and reads no file. An hour that gains, loses or
    rewrites a file has another digest; one row for each hour reaches the driver.
    """
    base = f"{root.rstrip('/')}/{kind}"
    days = [
        f"{base}/{day}"
        for day in files.folders(spark, base)
        if f"dt={first.isoformat()}" <= day <= f"dt={last.isoformat()}"
    ]
    if not days:
        return {}
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = reader.option("pathGlobFilter", "*.parquet").load(days)
    part = r"/dt=([0-9-]+)/hour=([0-9]+)/(.*)$"
    name = [F.regexp_extract("path", part, n) for n in (1, 2, 3)]
    line = F.concat_ws(" ", name[2], "length", F.unix_micros("modificationTime"))
    found = listed.groupBy(F.concat_ws("T", name[0], F.lpad(name[1], 2, "0")).alias("slot")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("mark")
    )
    return {row["slot"]: row["mark"] for row in found.collect()}


def read_hours(spark: SparkSession, root: str, kind: str, slots: Iterable[str]) -> DataFrame:
    """One kind of event of some hours that :func:`hour_marks` found; reads no other."""
    base, schema = f"{root.rstrip('/')}/{kind}", lake_schema(kind)
    paths = [f"{base}/dt={s[:10]}/hour={int(s[11:])}" for s in sorted(slots)]
    if not paths:
        return spark.createDataFrame([], schema).drop("batch")
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("batch")


def for_reports(events: DataFrame) -> DataFrame:
    """Add the columns the daily reports group by."""
    return events.withColumn("metric_date", F.col("dt")).withColumn(
        "event_ms", F.unix_millis("event_ts")
    )


def source_has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a path exists and holds at least one row; reads no more than that."""
    return not read_or_empty(spark, path, T.StructType(), infer=True).isEmpty()
