"""The daily batch: lake in, result tables out, one job for any number of days."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import parse_date
from millrace.operators import activity, daily, funnel, ingest, items, ops, sessions
from millrace.session import work_path
from millrace.sinks import published, tables
from millrace.sources import lake
from millrace.sources.tables import read_table

PIPELINE = "spark_batch_processing"


def daily_reports(
    clicks: DataFrame, purchases: DataFrame, top_items: int = 100, top_categories: int = 20
) -> dict[str, DataFrame]:
    """All result tables of the batch. Input needs metric_date and event_ms.

    They share the narrow activity rows, which are written once to the shared
    folder, so that the lake is not scanned for each.
    """
    spark = clicks.sparkSession
    act = activity.activity(clicks, purchases)
    path = work_path(spark, "activity")
    act.write.parquet(path)
    return reports_of(spark.read.schema(act.schema).parquet(path), top_items, top_categories)


def reports_of(
    act: DataFrame, top_items: int = 100, top_categories: int = 20
) -> dict[str, DataFrame]:
    """The result tables from activity rows, or from hourly sums of them."""
    return {
        "daily_metrics": ingest.stamp(daily.daily_metrics(act), "created_at", "updated_at"),
        "popular_items": ingest.stamp(items.popular_items(act, top_items)),
        "popular_categories": ingest.stamp(
            items.top_categories(items.activity_category_stats(act), top_categories)
        ),
        "session_funnel": ingest.stamp(funnel.session_funnel(act)),
    }


def run_daily(
    spark: SparkSession,
    lake_root: str,
    tables_root: str,
    start: str | dt.date,
    end: str | dt.date | None = None,
    names: Iterable[str] | None = None,
    top_items: int = 100,
    top_categories: int = 20,
) -> dict[str, int]:
    """Compute and replace the days ``start``..``end``; rows written per table.

    Purchases may be missing; a range without clicks is an error. A day without
    rows ends up empty. Every run, also one without data, leaves a RUNNING and a
    closing row in ``pipeline_runs``.
    """
    first = parse_date(start)
    last = parse_date(end) if end is not None else first
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    runs_path = f"{tables_root}/pipeline_runs"
    run_id = uuid.uuid4().hex
    started_at = dt.datetime.now(dt.timezone.utc)
    run = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(first).alias("run_date"))
    started = ops.run_started(run, PIPELINE, F.lit(started_at))
    started.write.mode("append").parquet(runs_path)

    written: dict[str, int] = {}
    try:
        clicks = lake.for_reports(lake.read_events(spark, lake_root, "click", first, last))
        if clicks.isEmpty():
            raise ValueError(f"no click data for {first} .. {last}")
        purchases = lake.for_reports(lake.read_events(spark, lake_root, "purchase", first, last))
        reports = daily_reports(clicks, purchases, top_items, top_categories)
        for name in names or reports:
            path = f"{tables_root}/{name}"
            written[name] = tables.replace_dates(reports[name], path, days=days)
    except Exception as error:
        ops.run_ended(started, "FAILED", error=str(error)).write.mode("append").parquet(runs_path)
        raise
    ops.run_ended(started, "SUCCESS", sum(written.values())).write.mode("append").parquet(
        runs_path
    )
    return written


def run_sessions(
    spark: SparkSession,
    lake_root: str,
    tables_root: str,
    start: str | dt.date,
    end: str | dt.date | None = None,
) -> int:
    """Compute and publish the session summaries of some days; rows written.

    Sessions are flagged by the anomaly table below ``tables_root``, if there is
    one. A session is one row on its first day, whichever days are run in
    whichever order: digests of the days that were run before are kept in
    ``session_digests``, and a session that goes on there is summed up anew.
    """
    first = parse_date(start)
    last = parse_date(end) if end is not None else first
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    clicks, purchases = (
        lake.for_reports(lake.read_events(spark, lake_root, kind, first, last))
        for kind in ("click", "purchase")
    )
    kept, target = f"{tables_root}/session_digests", f"{tables_root}/session_summary"

    def folder(day: dt.date) -> str:
        return f"metric_date={day.isoformat()}"

    def stored(wanted: list[dt.date], number: int) -> DataFrame:
        names = {folder(day) for day in wanted}
        return published.read(spark, kept, sessions.DIGEST, names.__contains__, number)

    def written(df: DataFrame) -> DataFrame:
        path = work_path(spark, "linked-sessions")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    before = published.version(spark, kept).number
    tables.replace_dates(sessions.digests(activity.activity(clicks, purchases)), kept, days=days)
    now = published.version(spark, kept).number
    parts = [stored(days, now)]
    reach = [first, last]
    for edge, step in ((0, -1), (1, 1)):
        day = reach[edge]
        # Sessions of the edge as it is, and as it was: those may end elsewhere now.
        open_ = stored([day], now).unionByName(stored([day], before)).select("session_id").distinct()
        more = sessions.linked_days(
            open_, step, lambda n: stored([day + dt.timedelta(days=n)], now), written
        )
        parts += more
        reach[edge] = day + dt.timedelta(days=step * len(more))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    anomalies = read_table(spark, tables_root, "anomaly_sessions", missing_ok=True)
    report = sessions.summaries(rows, anomalies)

    base = published.version(spark, target)
    around = [reach[0] + dt.timedelta(days=n) for n in range((reach[1] - reach[0]).days + 1)]
    others = {folder(day) for day in around if not first <= day <= last}
    if others & base.folders.keys():
        old = published.read(spark, target, None, others.__contains__, base.number)
        same = rows.select("session_id", "metric_date").distinct()
        report = report.unionByName(
            old.join(same, ["session_id", "metric_date"], "left_anti").select(*report.columns)
        )
    folders = [folder(day) for day in around]
    return published.replace(report, target, "metric_date", folders, base=base)
