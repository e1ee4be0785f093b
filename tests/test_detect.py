"""Windows, thresholds and scores."""

import datetime as dt

import pytest
from support import at, rows
from pyspark.sql import functions as F

from millrace.operators import detect

EVENT = "session_id long, item_id long, event_ts timestamp, kafka_ingest_ts timestamp"
NOON = at("2026-01-11T12:00:00")


def burst(session, n, items, start=NOON, seconds=9.0):
    """n clicks spread over some seconds, cycling through the items."""
    step = dt.timedelta(seconds=seconds / n)
    return [(session, i % items, start + i * step, start + i * step) for i in range(n)]


@pytest.mark.parametrize(("clicks", "scores"), [(50, []), (51, [1.02]), (60, [1.2])])
def test_high_frequency_is_strict(make, clicks, scores):
    found = detect.detect_high_frequency(make(EVENT, burst(1, clicks, 3)))
    assert [r["anomaly_score"] for r in found.collect()] == scores


def test_split_over_two_windows_is_no_anomaly(make):
    data = burst(1, 26, 3) + burst(1, 25, 3, NOON + dt.timedelta(seconds=10))
    assert detect.detect_high_frequency(make(EVENT, data)).count() == 0


def test_high_frequency_columns(make):
    row = detect.detect_high_frequency(make(EVENT, burst(1, 60, 3) + burst(2, 10, 5))).first()
    assert row["session_id"] == 1 and row["anomaly_type"] == "HIGH_FREQUENCY"
    assert (row["click_count"], row["unique_items"]) == (60, 3)
    assert row["event_ts"] == int(NOON.timestamp()) * 1000
    assert row["detected_at"] == row["last_event_ts"]
    assert (row["window_end"] - row["window_start"]).total_seconds() == 10
    assert list(row.asDict()) == detect.COLUMNS


@pytest.mark.parametrize(("clicks", "items", "found"), [(60, 6, 0), (60, 5, 2), (50, 2, 0), (80, 20, 0)])
def test_bot_like_is_strict(make, clicks, items, found):
    late_half = NOON + dt.timedelta(seconds=30)
    df = make(EVENT, burst(1, clicks, items, late_half, 25))
    out = detect.detect_bot_like(df)
    assert out.count() == found
    assert out.select("event_id").distinct().count() == found


def test_bot_score(make):
    df = make(EVENT, burst(1, 80, 2, NOON + dt.timedelta(seconds=30), 25))
    assert [r["anomaly_score"] for r in detect.detect_bot_like(df).collect()] == [1.56, 1.56]


def test_id_does_not_move_with_an_earlier_event(make):
    data = burst(1, 60, 3, NOON + dt.timedelta(seconds=1), 5)
    early = (1, 0, NOON, NOON)
    before = detect.detect_high_frequency(make(EVENT, data)).first()
    after = detect.detect_high_frequency(make(EVENT, [*data, early])).first()
    assert before["event_id"] == after["event_id"]
    assert before["first_event_ts"] != after["first_event_ts"]


def test_ready_made_windows_can_be_classified(make):
    """Counts that were aggregated elsewhere go through the same rules."""
    schema = ("session_id long, window_start timestamp, window_end timestamp, first_event_ts "
              "timestamp, last_event_ts timestamp, click_count long, unique_items long, "
              "kafka_ingest_ts timestamp")
    times = [NOON] * 4
    df = make(schema, [(1, *times, 80, 2, NOON), (2, *times, 80, 20, NOON), (3, *times, 30, 1, NOON)])
    assert rows(detect.bot_like(df), "session_id", "anomaly_score") == [(1, 1.56)]
    assert rows(detect.high_frequency(df), "session_id") == [(1,), (2,)]


def test_windows_equal_brute_force(make):
    """A session with most rows, sliding windows, exact distinct items."""
    data = burst(1, 400, 37, seconds=200) + burst(2, 30, 4, seconds=90) + burst(3, 1, 1)
    out = detect.session_windows(make(EVENT, data), "1 minute", "30 seconds")
    expected = {}
    for session, item, ts, _ in data:
        base = int(ts.timestamp()) // 30 * 30
        for start in (base, base - 30):
            entry = expected.setdefault((session, start), [0, set()])
            entry[0] += 1
            entry[1].add(item)
    found = {
        (r["session_id"], r["start"]): (r["click_count"], r["unique_items"])
        for r in out.select("*", F.unix_seconds("window_start").alias("start")).collect()
    }
    assert found == {k: (n, len(items)) for k, (n, items) in expected.items()}


def test_null_items_count_as_clicks_only(make):
    df = make(EVENT, [(1, None, NOON, None), (1, 5, NOON, None)])
    assert rows(detect.session_windows(df, "10 seconds"), "click_count", "unique_items") == [(2, 1)]


def test_approximate_form_agrees_on_few_items(make):
    df = make(EVENT, burst(1, 60, 3))
    exact = detect.session_windows(df, "10 seconds")
    sketch = detect.session_windows(df, "10 seconds", exact=False)
    assert rows(exact) == rows(sketch)
