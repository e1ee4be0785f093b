"""The daily batch by changed hours.

``hour_partials`` holds additive sums of each hour of the lake, marked with the
files they were computed from. A refresh lists the folders of the wanted days,
reads the hours whose files differ from the mark, and publishes sums and marks in
one step. Every report keeps the runs of the sums it was computed from as the
mark of each day, so a day is summed up again when, and only when, one of its
hours changed; a refresh that died half way is finished by the next one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.times import parse_date
from millrace.operators import activity, partials
from millrace.plans.daily_jobs import reports_of
from millrace.sinks import published, tables
from millrace.sources import lake

SUMS = "hour_partials"
KINDS = ("click", "purchase")


@dataclass
class Refreshed:
    """Hours read from the lake, hours that are gone, and days by report."""

    hours: list[str] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)
    days: dict[str, list[str]] = field(default_factory=dict)


def _mark(parts: object) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def refresh_sums(
    spark: SparkSession, lake_root: str, tables_root: str, first: dt.date, last: dt.date
) -> tuple[list[str], list[str]]:
    """Bring the sums of a range of days up to date; hours read and hours gone.

    Files are listed before they are read: what arrives in between makes the
    mark differ, and the next refresh reads the hour again.
    """
    path = f"{tables_root}/{SUMS}"
    base = published.version(spark, path)
    found = {kind: lake.hour_marks(spark, lake_root, kind, first, last) for kind in KINDS}
    marks = {
        f"slot={slot}": _mark([found[kind].get(slot) for kind in KINDS])
        for slot in {slot for hours in found.values() for slot in hours}
    }
    low, high = f"slot={first.isoformat()}", f"slot={last.isoformat()}T99"
    known = {f for f in base.marks.keys() | base.folders.keys() if low <= f <= high}
    changed = sorted(f for f, mark in marks.items() if base.marks.get(f) != mark)
    gone = sorted(known - marks.keys())
    if not changed and not gone:
        return [], []
    hours = [f.removeprefix("slot=") for f in changed]
    clicks, purchases = (
        lake.for_reports(
            lake.read_hours(spark, lake_root, kind, [s for s in hours if s in found[kind]])
        )
        for kind in KINDS
    )
    sums = partials.partials(activity.activity(clicks, purchases))
    published.replace(
        sums, path, "slot", [*changed, *gone], base=base, marks={f: marks[f] for f in changed}
    )
    return hours, [f.removeprefix("slot=") for f in gone]


def refresh_daily(
    spark: SparkSession,
    lake_root: str,
    tables_root: str,
    start: str | dt.date,
    end: str | dt.date | None = None,
    top_items: int = 100,
    top_categories: int = 20,
) -> Refreshed:
    """Bring the daily reports and the hourly sketches of some days up to date.

    Reads the changed hours of the lake, and of the days they lie in the sums.
    The tables hold what a run over all events of these days would write; a day
    without events becomes empty.
    """
    first = parse_date(start)
    last = parse_date(end) if end is not None else first
    done = Refreshed(*refresh_sums(spark, lake_root, tables_root, first, last))
    path = f"{tables_root}/{SUMS}"
    sums = published.version(spark, path)
    wanted: dict[str, list] = {}
    for folder in sorted(sums.folders):
        day = folder.removeprefix("slot=")[:10]
        if first.isoformat() <= day <= last.isoformat():
            wanted.setdefault(day, []).append([folder, sums.folders[folder]])

    def rows_of(days: list[str]) -> DataFrame:
        def among(folder: str) -> bool:
            return folder.removeprefix("slot=")[:10] in days

        return published.read(spark, path, partials.PARTIAL, among, sums.number)

    def stale(name: str) -> list[str]:
        now = published.version(spark, f"{tables_root}/{name}")
        prefix = "metric_date="
        known = {f.removeprefix(prefix) for f in now.folders}
        kept = {day for day in known if first.isoformat() <= day <= last.isoformat()}
        return sorted(
            day
            for day in wanted.keys() | kept
            if day not in wanted or now.marks.get(f"{prefix}{day}") != _mark(wanted[day])
        )

    names = ["daily_metrics", "popular_items", "popular_categories", "session_funnel"]
    for name in [*names, "hour_sketches"]:
        days = stale(name)
        if not days:
            continue
        rows = rows_of(days)
        if name == "hour_sketches":
            report = partials.hour_sketches(rows)
        else:
            report = reports_of(rows, top_items, top_categories)[name]
        marks = {f"metric_date={day}": _mark(wanted[day]) for day in days if day in wanted}
        tables.replace_dates(report, f"{tables_root}/{name}", days=days, marks=marks)
        done.days[name] = days
    return done
