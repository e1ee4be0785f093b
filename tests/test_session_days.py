"""Sessions that go on over midnight, run day by day."""

import datetime as dt
import itertools

import pytest
from support import at, rows

from millrace import files, schemas
from millrace.operators import activity, sessions
from millrace.plans import daily_jobs
from millrace.sinks import lake as lake_sink
from millrace.sources import lake
from millrace.sources.tables import read_table

SHOWN = ["session_id", "metric_date", "click_count", "unique_items_viewed", "duration_sec"]


def click(session, text, item=1, category="S"):
    t = at(f"2026-01-{text}")
    return (session, t, item, category, "click", f"{session}-{text}-{item}", t, "x")


# Session 1 goes over two midnights, 2 pauses for a day, 3 is on one day, 4 over one midnight.
DATA = [
    click(1, "10T23:50:00"), click(1, "11T00:10:00", 2, "5"), click(1, "11T12:00:00"), click(1, "12T00:05:00", 3),
    click(2, "10T08:00:00"), click(2, "12T08:00:00"), click(3, "11T09:00:00"), click(4, "11T23:59:00"), click(4, "12T00:01:00"),
]
DAY = {d: dt.date(2026, 1, d) for d in range(9, 14)}
WANT = sorted([
    (1, DAY[10], 4, 3, 87300), (2, DAY[10], 1, 1, 0), (2, DAY[12], 1, 1, 0),
    (3, DAY[11], 1, 1, 0), (4, DAY[11], 2, 1, 120),
], key=repr)


@pytest.fixture
def root(spark, make, folder):
    lake_sink.write_lake(make(schemas.CLICK, DATA), f"{folder}/lake", "click", "a")
    return folder


@pytest.mark.parametrize("order", list(itertools.permutations([10, 11, 12])))
def test_any_order_of_days(spark, root, order):
    for day in order:
        daily_jobs.run_sessions(spark, f"{root}/lake", f"{root}/t", DAY[day])
    found = read_table(spark, f"{root}/t", "session_summary")
    assert rows(found, *SHOWN) == WANT
    assert rows(found.filter("session_id = 1"), "categories_viewed") == [(["5", "S"],)]


def test_equals_one_run_and_is_repeatable(spark, root):
    for _ in range(2):
        daily_jobs.run_sessions(spark, f"{root}/lake", f"{root}/t", DAY[9], DAY[13])
    assert rows(read_table(spark, f"{root}/t", "session_summary"), *SHOWN) == WANT


def test_a_corrected_day_moves_the_sessions_around_it(spark, make, root):
    daily_jobs.run_sessions(spark, f"{root}/lake", f"{root}/t", DAY[10], DAY[12])
    # The middle day of session 1 was wrong: it had other events only.
    kept = [r for r in DATA if not (r[0] == 1 and r[1].day == 11)] + [click(4, "11T23:00:00", 7)]
    files.delete(spark, f"{root}/lake/click/dt=2026-01-11")
    lake_sink.write_lake(make(schemas.CLICK, kept), f"{root}/lake", "click", "a")
    daily_jobs.run_sessions(spark, f"{root}/lake", f"{root}/t", DAY[11])
    assert rows(read_table(spark, f"{root}/t", "session_summary"), *SHOWN) == sorted([
        (1, DAY[10], 1, 1, 0), (1, DAY[12], 1, 1, 0), (2, DAY[10], 1, 1, 0), (2, DAY[12], 1, 1, 0),
        (3, DAY[11], 1, 1, 0), (4, DAY[11], 3, 2, 3660)], key=repr)


def test_digests_sum_up_to_the_summary(spark, root):
    clicks = lake.for_reports(lake.read_events(spark, f"{root}/lake", "click").filter("session_id <> 2"))
    none = lake.for_reports(lake.read_events(spark, f"{root}/lake", "purchase"))
    act = activity.activity(clicks, none)
    anomalies = spark.createDataFrame([(3,)], "session_id long")
    assert rows(sessions.summaries(sessions.digests(act), anomalies)) == rows(sessions.session_summary(act, anomalies))
