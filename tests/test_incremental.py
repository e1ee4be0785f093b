"""The daily batch by changed hours, against the batch over whole days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import at, rows

from millrace import files, schemas
from millrace.operators import activity, partials
from millrace.plans import daily_jobs, incremental
from millrace.sinks import lake as lake_sink
from millrace.sinks import published, tables
from millrace.sources import lake
from millrace.sources.tables import read_table

REPORTS = ["daily_metrics", "popular_items", "popular_categories", "session_funnel"]
FIRST, LAST = dt.date(2026, 1, 10), dt.date(2026, 1, 12)


def click(session, text, item=1, category="S"):
    t = at(f"2026-01-{text}")
    return (session, t, item, category, "click", f"{session}-{text}-{item}", t, "x")


def purchase(session, text, item=1, price="2.50", quantity=2):
    t = at(f"2026-01-{text}")
    row = dict(session_id=session, event_ts=t, item_id=item, price=price, quantity=quantity)
    return row | dict(event_type="purchase", event_id=f"{session}-{text}", ingest_ts=t, source="x")


CLICKS = [
    click(1, "10T07:10:00"), click(1, "10T07:50:00", 2, None), click(1, "10T08:05:00", 1, "5"),
    click(2, "10T08:30:00", None, "5"), click(2, "10T23:59:59", 1, "5"), click(2, "11T00:00:00"),
    click(3, "11T09:00:00", 4, None), click(3, "11T09:00:00", 4, None), click(4, "12T12:00:00", 2),
]
PURCHASES = [
    purchase(1, "10T08:06:00"), purchase(1, "10T08:06:30", 2, "1.00", 1), purchase(5, "11T03:00:00", 4),
    purchase(3, "11T09:05:00", None, "7.00", 1),
]


@pytest.fixture
def load(spark, make, folder):
    def write(clicks, purchases, batch):
        if clicks:
            lake_sink.write_lake(make(schemas.CLICK, clicks), f"{folder}/lake", "click", batch)
        if purchases:
            names = schemas.PURCHASE.names
            typed = spark.createDataFrame(
                [tuple(p[n] for n in names) for p in purchases],
                ", ".join(f"{f.name} {'string' if f.name == 'price' else f.dataType.simpleString()}" for f in schemas.PURCHASE),
            ).withColumn("price", F.col("price").cast(schemas.PURCHASE["price"].dataType))
            lake_sink.write_lake(typed, f"{folder}/lake", "purchase", batch)

    return write


def refresh(spark, folder):
    return incremental.refresh_daily(spark, f"{folder}/lake", f"{folder}/t", FIRST, LAST)


def expected(spark, folder):
    clicks, purchases = (
        lake.for_reports(lake.read_events(spark, f"{folder}/lake", kind)) for kind in ("click", "purchase")
    )
    return daily_jobs.daily_reports(clicks, purchases)


def same_as_whole(spark, folder):
    for name, report in expected(spark, folder).items():
        found = read_table(spark, f"{folder}/t", name)
        shown = [c for c in report.columns if c not in ("created_at", "updated_at")]
        assert rows(found, *shown) == rows(report, *shown), name


def test_only_changed_hours_are_read(spark, load, folder):
    load(CLICKS, PURCHASES, "a")
    first = refresh(spark, folder)
    assert first.hours == [
        "2026-01-10T07", "2026-01-10T08", "2026-01-10T23", "2026-01-11T00", "2026-01-11T03",
        "2026-01-11T09", "2026-01-12T12",
    ]
    same_as_whole(spark, folder)
    again = refresh(spark, folder)
    assert (again.hours, again.gone, again.days) == ([], [], {})

    load([click(6, "10T08:59:00", 9)], [], "late")
    late = refresh(spark, folder)
    assert late.hours == ["2026-01-10T08"] and set(map(tuple, late.days.values())) == {("2026-01-10",)}
    same_as_whole(spark, folder)


def test_hours_and_days_that_go(spark, load, folder):
    load(CLICKS, PURCHASES, "a")
    refresh(spark, folder)
    files.delete(spark, f"{folder}/lake/click/dt=2026-01-10/hour=7")
    files.delete(spark, f"{folder}/lake/click/dt=2026-01-12")
    found = refresh(spark, folder)
    assert found.hours == [] and found.gone == ["2026-01-10T07", "2026-01-12T12"]
    assert found.days["daily_metrics"] == ["2026-01-10", "2026-01-12"]
    same_as_whole(spark, folder)
    assert read_table(spark, f"{folder}/t", "daily_metrics").filter("metric_date = '2026-01-12'").isEmpty()


def test_a_refresh_that_dies_is_finished_by_the_next(spark, load, folder, monkeypatch):
    load(CLICKS, PURCHASES, "a")
    refresh(spark, folder)
    load([click(6, "11T09:59:00", 9)], [], "late")
    real, calls = tables.replace_dates, []

    def dies(df, path, **options):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(df, path, **options)

    monkeypatch.setattr(tables, "replace_dates", dies)
    with pytest.raises(RuntimeError):
        refresh(spark, folder)
    monkeypatch.undo()
    rest = refresh(spark, folder)
    assert rest.hours == [] and "daily_metrics" not in rest.days and "popular_items" in rest.days
    same_as_whole(spark, folder)


def test_a_day_written_by_others_is_summed_up_again(spark, load, folder):
    load(CLICKS, PURCHASES, "a")
    refresh(spark, folder)
    other = read_table(spark, f"{folder}/t", "daily_metrics").filter("metric_date = '2026-01-10'")
    tables.replace_date(other.selectExpr("* except (total_clicks)", "99L as total_clicks"), f"{folder}/t/daily_metrics", "2026-01-10")
    assert refresh(spark, folder).days == {"daily_metrics": ["2026-01-10"]}
    same_as_whole(spark, folder)


def test_an_empty_lake_writes_nothing(spark, folder):
    found = refresh(spark, folder)
    assert (found.hours, found.gone, found.days) == ([], [], {})
    assert not published.exists(spark, f"{folder}/t/daily_metrics")


def test_sketches_merge_over_days(spark, load, folder):
    load(CLICKS, PURCHASES, "a")
    refresh(spark, folder)
    hours = published.read(spark, f"{folder}/t/hour_sketches")
    assert rows(partials.over_range(hours).drop("total_revenue")) == [(9, 4, 4, 3, 3)]
    by_day = partials.over_range(hours, "metric_date")
    assert rows(by_day, "metric_date", "unique_sessions", "purchase_sessions", "unique_items") == [
        (dt.date(2026, 1, 10), 2, 1, 2), (dt.date(2026, 1, 11), 2, 2, 2), (dt.date(2026, 1, 12), 1, 0, 1),
    ]


def test_sketch_error_of_many_sessions(spark):
    made = spark.range(400_000).selectExpr(
        "date'2026-01-01' + cast(id % 7 as int) metric_date", "'click' kind", "id % 150000 session_id",
        "id % 40000 item_id", "'1' category", "id * 1000 event_ms", "cast(null as decimal(23,2)) revenue")
    assert made.columns == activity.COLUMNS
    found = partials.over_range(partials.hour_sketches(partials.partials(made))).first()
    assert abs(found.unique_sessions - 150_000) <= partials.SKETCH_ERROR * 150_000
    assert abs(found.unique_items - 40_000) <= partials.SKETCH_ERROR * 40_000
    assert found.total_clicks == 400_000
