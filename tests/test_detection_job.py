"""The detection job as one query: equality with batch, replay, state."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import at, rows

from millrace.operators import detect, panes
from millrace.plans import registered
from millrace.sinks import published
from millrace.sinks.anomalies import compact_anomalies, read_anomaly_table
from millrace.streaming import detection, jobs

EVENT = ("event_id string, session_id long, item_id long, event_type string, "
         "event_ts timestamp, kafka_ingest_ts timestamp")
NOON = at("2026-01-11T12:00:00")
COLUMNS = [c for c in detect.COLUMNS if c != "spark_process_ts"]


def click(i, session=1, item=1, seconds=0.0):
    t = NOON + dt.timedelta(seconds=seconds)
    return (str(i), session, item, "click", t, t)


def settings(**more):
    return jobs.DetectionSettings(
        **{"high_frequency_clicks": 5, "bot_clicks": 5, "bot_diversity": 0.6,
           "trigger": jobs.AVAILABLE_NOW, "now": NOON + dt.timedelta(minutes=5)} | more)


@pytest.fixture
def arriving(spark, make, folder):
    """arriving([rows, ...]) -> a stream of one file after the other."""
    count = [0]

    def build(*parts):
        for part in parts:
            count[0] += 1
            make(EVENT, part).coalesce(1).write.parquet(f"{folder}/in/part={count[0]:03d}")
        return (spark.readStream.schema(make(EVENT, []).schema)
                .option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*"))

    return build


def expected(make, data, s):
    batch = make(EVENT, data).dropDuplicates(["event_id"])
    return rows(
        detect.detect_high_frequency(batch, s.high_frequency_window, s.high_frequency_clicks)
        .unionByName(detect.detect_bot_like(batch, s.bot_window, s.bot_slide, s.bot_clicks, s.bot_diversity))
        .select(COLUMNS))


def test_panes_serve_all_windows(make):
    assert panes.pane_seconds("10 seconds", "1 minute", "30 seconds") == 10
    assert panes.pane_seconds("1 day", "2 days", "1 day") == 86400
    data = [click(i, 1 + i % 2, i % 7, seconds=i * 1.7 - 30) for i in range(90)]
    data += [(str(i), 1, None, "click", *click(0)[4:]) for i in range(200, 204)]
    events = make(EVENT, data)
    parts = [panes.digest(events.filter(F.col("event_id") % 3 == n), 10) for n in range(3)]
    merged = panes.merge(parts[0].withColumn("changed_in", F.lit(0).cast("long")), parts[1], 1)
    merged = panes.merge(merged, parts[2], 2)
    for size, slide in (("10 seconds", None), ("1 minute", "30 seconds"), ("30 seconds", "10 seconds")):
        exact = detect.session_windows(events, size, slide)
        assert rows(panes.windows(merged, size, slide).select(*exact.columns)) == rows(exact)


def test_equals_batch_over_many_batches(spark, make, arriving, folder):
    data = [click(i, 1 + i % 3, i % 2, seconds=i * 0.4) for i in range(120)]
    parts = [data[n:n + 30] + data[max(0, n - 5):n] for n in range(0, 120, 30)]
    query = detection.start_detection_query(arriving(*parts), folder, f"{folder}/cp", settings())
    query.awaitTermination()
    want = expected(make, data, settings())
    assert len(want) > 3
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == want
    # One state store for all outputs.
    states = [json.loads(p.json)["stateOperators"] for p in query.recentProgress]
    assert {len(s) for s in states} == {1}
    compact_anomalies(spark, folder)
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == want


def test_distinct_items_are_exact(spark, make, arriving, folder):
    """Thousands of items: a sketch would be off, and the diversity with it."""
    data = [click(i, 1, i % 2999, seconds=(i % 50) / 10) for i in range(6000)]
    s = settings(bot_clicks=50, bot_diversity=0.4999)
    detection.start_detection_query(arriving(data[:2500], data[2500:]), folder, f"{folder}/cp", s).awaitTermination()
    found = read_anomaly_table(spark, folder).filter("anomaly_type = 'BOT_LIKE'")
    assert rows(found, "click_count", "unique_items") == [(6000, 2999)] * 2
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == expected(make, data, s)


def test_a_window_that_is_a_hit_no_longer_goes(spark, make, arriving, folder):
    """Six clicks on three items are a hit; later events lift the diversity."""
    first = [click(i, item=i % 3, seconds=i) for i in range(6)]
    more = [click(i, item=i, seconds=i) for i in range(6, 9)]
    again = [click(i, item=0, seconds=9 + i / 9) for i in range(9, 13)]
    s = settings(high_frequency_clicks=50)
    for part, hits in ((first, 2), (more, 0), (again, 2)):
        query = detection.start_detection_query(arriving(part), folder, f"{folder}/cp", s)
        query.awaitTermination()
        assert read_anomaly_table(spark, folder).count() == hits
        # The first window is compacted as a hit, then as taken back.
        compact_anomalies(spark, folder)
        assert read_anomaly_table(spark, folder).count() == hits
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == expected(make, first + more + again, s)


def test_side_outputs(spark, arriving, folder):
    lost = ("7", None, 1, "click", NOON, NOON)
    stream = arriving([click(1), click(2, seconds=-1200), lost], [click(3, seconds=-1300)])
    detection.start_detection_query(stream, folder, f"{folder}/cp", settings()).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/late_events"), "key") == [("2",), ("3",)]
    assert rows(spark.read.parquet(f"{folder}/dead_letters"), "key") == [("7",)]


def test_a_batch_that_died_is_counted_once(spark, make, arriving, folder):
    """The job dies after the panes are published and before the anomalies are."""
    data = [click(i, seconds=i * 0.1) for i in range(20)]
    stream = arriving(data[:12], data[12:])
    s = settings()
    fails = [1]
    good = detection.Detector(folder, s)

    def sink(anomalies, batch_id):
        if batch_id == 1 and fails:
            fails.pop()
            raise RuntimeError("lost")
        good._append(anomalies, batch_id)

    with pytest.raises(Exception):
        detection.start_detection_query(stream, folder, f"{folder}/cp", s, sink).awaitTermination()
    assert published.version(spark, f"{folder}/{detection.PANES}").batches == {"detection": 1}
    detection.start_detection_query(stream, folder, f"{folder}/cp", s, sink).awaitTermination()
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == expected(make, data, s)


def test_old_panes_go(spark, make, arriving, folder):
    early, late = [click(i, seconds=i) for i in range(30)], [click(100 + i, seconds=3600 + i) for i in range(30)]
    s = settings(now=NOON)
    detection.start_detection_query(arriving(early, late), folder, f"{folder}/cp", s).awaitTermination()
    path = f"{folder}/{detection.PANES}"
    before = published.read(spark, path).count()
    detection.Detector(folder, s).tidy()
    left = published.read(spark, path)
    assert 0 < left.count() < before
    assert left.agg(F.min("pane_start")).first()[0] >= dt.datetime(2026, 1, 11, 13)
    assert rows(read_anomaly_table(spark, folder).select(COLUMNS)) == expected(make, early + late, s)


def test_the_anomaly_table_keeps_one_state(spark, folder, monkeypatch):
    """Both detectors read the events once; only the deduplication has a state store."""
    monkeypatch.setattr(registered, "work_path", lambda spark, name: f"{folder}/{name}")
    found = registered.QUERIES["stream_anomaly_table"](spark, "/root/testdata/sf0.001")
    assert found.count() > 0
    state = Path(f"{folder}/stream_anomalies/checkpoint")
    assert [p.name for p in state.iterdir()] == [detection.NAME]
    assert [p.name for p in (state / detection.NAME / "state").iterdir() if p.is_dir()] == ["0"]
    batches = Path(f"{folder}/stream_anomalies/anomaly_batches")
    # The first detector's batch is compacted before the second's is written.
    assert not list((batches / "high_frequency").glob("batch_id=*"))
    assert list((batches / "bot_like").glob("batch_id=*"))
