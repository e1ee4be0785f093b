"""Streams on files: equality with batch, duplicates, restart, side outputs, logs."""

import datetime as dt
import json
from pathlib import Path

import pytest
from support import at, rows
from pyspark.sql import functions as F

from millrace.operators import detect, ingest, progress
from millrace.plans.registered import QUERIES
from millrace.schemas import CLICK_CSV
from millrace.sources import lake, progress_log
from millrace.sinks.anomalies import batches_path, compact_anomalies, read_anomaly_table
from millrace.streaming import jobs
from millrace.streaming.listener import JsonLines, ProgressListener

EVENT = ("event_id string, session_id long, item_id long, event_type string, "
         "event_ts timestamp, kafka_ingest_ts timestamp")
NOON = at("2026-01-11T12:00:00")


def click(i, session=1, item=1, seconds=0.0):
    t = NOON + dt.timedelta(seconds=seconds)
    return (str(i), session, item, "click", t, t)


class Source:
    """Parquet files that arrive one after the other."""

    def __init__(self, spark, make, folder):
        self.spark, self.make, self.path, self.n = spark, make, f"{folder}/in", 0

    def add(self, data):
        self.n += 1
        self.make(EVENT, data).coalesce(1).write.parquet(f"{self.path}/part={self.n:03d}")

    def stream(self):
        schema = self.make(EVENT, []).schema
        return (self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{self.path}/*"))


@pytest.fixture
def source(spark, make, folder):
    return Source(spark, make, folder)


def run(df, folder, name="q", mode="append"):
    """Run what is available into Parquet and give the rows of this query so far."""
    out = f"{folder}/{name}"

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (df.writeStream.queryName(name).outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", f"{folder}/cp_{name}").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


SMALL = dict(high_frequency_window="10 seconds", high_frequency_clicks=5, bot_clicks=5,
             bot_diversity=0.6, trigger=jobs.AVAILABLE_NOW, late_trigger=jobs.AVAILABLE_NOW)


def test_duplicates_in_one_batch_and_across_batches(spark, source, folder):
    source.add([click(1), click(1), click(2, seconds=1)])
    source.add([click(1), click(3, seconds=2)])
    run(ingest.drop_duplicate_events(source.stream()), folder)
    assert rows(spark.read.parquet(f"{folder}/q").select("event_id")) == [("1",), ("2",), ("3",)]


def test_many_copies_are_thinned_first(spark, source, folder):
    source.add([click(1)] * 40 + [click(2)])
    source.add([click(1)] * 40 + [click(3)])
    query = run(ingest.drop_duplicate_events(source.stream(), spread=4), folder)
    assert rows(spark.read.parquet(f"{folder}/q").select("event_id")) == [("1",), ("2",), ("3",)]
    states = [json.loads(p.json)["stateOperators"] for p in query.recentProgress]
    assert max(len(s) for s in states) == 2


def test_dedup_state_is_evicted(source, folder):
    source.add([click(i, seconds=i) for i in range(50)])
    source.add([click(100, seconds=7200)])
    source.add([click(101, seconds=7201)])
    query = run(ingest.drop_duplicate_events(source.stream()), folder)
    last = json.loads(query.recentProgress[-1].json)
    assert last["stateOperators"][0]["numRowsTotal"] <= 2


def test_stream_equals_batch(spark, make, source, folder):
    data = [click(i, 1 + i % 3, i % 2, seconds=i * 0.4) for i in range(120)]
    for start in range(0, 120, 30):
        source.add(data[start:start + 30] + data[max(0, start - 5):start])
    settings = jobs.DetectionSettings(**SMALL, now=NOON + dt.timedelta(minutes=5))
    queries = jobs.start_detection(source.stream(), folder, f"{folder}/cp", settings)
    jobs.run_available(queries)
    batch = make(EVENT, data)
    expected = {
        "high_frequency": detect.detect_high_frequency(batch, "10 seconds", 5),
        "bot_like": detect.detect_bot_like(batch, threshold=5, diversity=0.6),
    }
    for name, frame in expected.items():
        found = read_anomaly_table(spark, folder).filter(
            F.col("anomaly_type") == name.upper()
        )
        columns = [c for c in detect.COLUMNS if c != "spark_process_ts"]
        assert frame.count() > 0
        assert rows(found.select(columns)) == rows(frame.select(columns))


def test_late_events_go_to_their_own_output(spark, source, folder):
    source.add([click(1), click(2, seconds=-1200)])
    settings = jobs.DetectionSettings(**SMALL, now=NOON + dt.timedelta(minutes=5))
    jobs.run_available(jobs.start_detection(source.stream(), folder, f"{folder}/cp", settings))
    late = spark.read.parquet(f"{folder}/late_events").collect()
    assert [r["key"] for r in late] == ["2"]


@pytest.mark.parametrize(
    ("seconds", "on_time", "in_window"),
    [(0, True, True), (-300, True, False), (-1200, False, False)],
)
def test_clock_and_watermark_are_two_filters(spark, source, folder, seconds, on_time, in_window):
    """A record may pass the clock's limit and still be behind the watermark."""
    source.add([click(1, seconds=60)])
    source.add([click(2, seconds=61)])
    source.add([click(3, session=9, seconds=seconds)])
    kept, _ = ingest.split_late(source.stream(), 10, NOON + dt.timedelta(minutes=1))
    unique = ingest.drop_duplicate_events(kept, "2 minutes")
    windows = detect.session_windows(unique, "10 seconds", exact=False)
    run(windows, folder, mode="update")
    seen = spark.read.parquet(f"{folder}/q").filter("session_id = 9").count()
    assert seen == (1 if on_time and in_window else 0)


def test_updates_of_a_window_replace_the_row(spark, source, folder):
    source.add([click(i, seconds=0) for i in range(6)])
    source.add([click(i, seconds=1) for i in range(6, 9)])
    found = detect.detect_high_frequency(
        ingest.drop_duplicate_events(source.stream()), "10 seconds", 5)
    query = jobs.start_anomalies(
        found, "hf", batches_path(folder, "hf"), f"{folder}/cp", jobs.AVAILABLE_NOW)
    query.awaitTermination()
    assert spark.read.parquet(batches_path(folder, "hf")).count() == 2
    assert rows(read_anomaly_table(spark, folder), "click_count") == [(9,)]
    compact_anomalies(spark, folder)
    assert rows(read_anomaly_table(spark, folder), "click_count") == [(9,)]


def test_restart_resumes_from_the_checkpoint(spark, source, folder):
    source.add([click(1), click(2)])
    first = run(ingest.drop_duplicate_events(source.stream()), folder)
    source.add([click(2), click(3)])
    second = run(ingest.drop_duplicate_events(source.stream()), folder)
    assert first.id == second.id and first.runId != second.runId
    assert sum(p.numInputRows for p in second.recentProgress) == 2
    assert rows(spark.read.parquet(f"{folder}/q").select("event_id")) == [("1",), ("2",), ("3",)]


def test_exact_distinct_is_refused_on_a_stream(source):
    source.add([click(1)])
    with pytest.raises(ValueError):
        detect.session_windows(source.stream(), "10 seconds", exact=True)


def test_ingest_job_parses_once_and_replays(spark, folder):
    Path(f"{folder}/raw").mkdir()
    with open(f"{folder}/raw/clicks.csv", "w", encoding="utf-8") as out:
        out.write("Session ID,Timestamp,Item ID,Category\n"
                  "1,2026-01-11T10:00:00.000Z,5,S\n2,2026-01-11T11:30:00.000Z,6,0\n"
                  ",2026-01-11T10:00:00.000Z,5,1\n")
    raw = spark.readStream.schema(CLICK_CSV).option("header", True).csv(
        f"{folder}/raw")
    for attempt in (1, 2):
        query = jobs.start_ingest(raw, "click", f"{folder}/lake", f"{folder}/dlq",
                                  f"{folder}/cp{attempt}", jobs.AVAILABLE_NOW)
        query.awaitTermination()
    stored = lake.read_events(spark, f"{folder}/lake", "click", "2026-01-11")
    assert rows(stored, "session_id", "category", "hour") == [(1, "S", 10), (2, None, 11)]
    letters = spark.read.parquet(f"{folder}/dlq").collect()
    assert len(letters) == 1
    assert json.loads(letters[0]["value"])["original_data"]["Item ID"] == "5"


def test_listener_log_feeds_the_reports(spark, source, folder):
    log = f"{folder}/log/progress.jsonl"
    listener = ProgressListener(log)
    spark.streams.addListener(listener)
    try:
        source.add([click(1), click(2)])
        run(ingest.drop_duplicate_events(source.stream()), folder, "logged")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    with open(log, "a", encoding="utf-8") as out:
        out.write("{broken\n")
    records = progress_log.read_progress_log(spark, log)
    kinds = {r[0] for r in records.select("event").distinct().collect()}
    assert "query_started" in kinds and "query_progress" in kinds
    summary = progress.progress_summary(progress_log.progress_rows(records)).first()
    assert (summary["name"], summary["input_rows"]) == ("logged", 2)
    assert summary["trigger_ms_max"] > 0


@pytest.mark.parametrize("deduplicate", [False, True])
def test_throughput_job_counts_rows(source, folder, deduplicate):
    source.add([click(1), click(1)])
    log = f"{folder}/batches.jsonl"
    query = jobs.start_throughput(
        source.stream(), f"{folder}/cp", log, deduplicate, jobs.AVAILABLE_NOW)
    query.awaitTermination()
    with open(log, encoding="utf-8") as lines:
        records = [json.loads(line) for line in lines]
    assert sum(r["rows"] for r in records) == (1 if deduplicate else 2)
    assert set(records[0]) == {"batch_id", "rows", "sink_action_ms", "recorded_at_epoch_ms"}


def test_console_and_stop(spark, source, folder):
    source.add([click(1)])
    query = jobs.write_console(source.stream(), "debug", rows=5, trigger={"availableNow": True})
    query.awaitTermination()
    counts = source.stream().groupBy("session_id").agg(F.count("*").alias("n"))
    query = jobs.write_console(counts, "debug2", "complete", trigger={"availableNow": True})
    query.awaitTermination()
    with pytest.raises(ValueError):
        jobs.write_keyed(source.stream(), "nowhere", folder)


def test_all_queries_stop_when_one_ends(spark, source, folder):
    source.add([click(1)])
    spark.streams.resetTerminated()
    running = (source.stream().writeStream.format("noop").queryName("long")
               .option("checkpointLocation", f"{folder}/a").trigger(processingTime="1 hour").start())
    ending = (source.stream().writeStream.format("noop").queryName("short")
              .option("checkpointLocation", f"{folder}/b").trigger(availableNow=True).start())
    jobs.run_until_any_stops(spark, {"long": running, "short": ending})
    assert not running.isActive and not ending.isActive


def test_records_on_a_store_are_read_back(spark, folder):
    out = JsonLines(f"file://{folder}/log")
    for n in range(3):
        out.write({"n": n})
    assert sorted(r["n"] for r in spark.read.json(f"{folder}/log").collect()) == [0, 1, 2]


def test_a_table_of_part_files_is_streamed_whole(spark, tmp_path):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_dedup", "stream_high_frequency"):
        whole = QUERIES[name](spark, "/root/testdata/sf0.001")
        parts = QUERIES[name](spark, str(tmp_path))
        assert parts.count() > 0
        assert rows(parts) == rows(whole.select(*parts.columns))


def test_a_window_that_is_a_hit_no_longer_goes(spark, source, folder):
    source.add([click(i, item=i % 3, seconds=i) for i in range(6)])
    source.add([click(i, item=i, seconds=i) for i in range(6, 9)])
    found = detect.detect_bot_like(
        ingest.drop_duplicate_events(source.stream()), threshold=5, diversity=0.6)
    query = jobs.start_anomalies(
        found, "bot", batches_path(folder, "bot"), f"{folder}/cp", jobs.AVAILABLE_NOW)
    query.awaitTermination()
    batches = spark.read.parquet(batches_path(folder, "bot"))
    assert batches.filter("batch_id = 0 AND anomaly_score IS NOT NULL").count() == 2
    assert rows(read_anomaly_table(spark, folder)) == []
    compact_anomalies(spark, folder)
    assert rows(read_anomaly_table(spark, folder)) == []
