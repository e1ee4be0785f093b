"""Repairs, parsing, late split, rejects."""

import json

from support import at, rows
from pyspark.sql import functions as F

from millrace.functions import ids
from millrace.operators import ingest

NOW = "2026-01-11 12:00:00"


def test_repair_fills_ids_and_ingest_times(make):
    broker = at("2026-01-11T12:00:00")
    df = make(
        "session_id long, event_ts long, item_id long, event_type string, event_id string, "
        "ingest_ts long, kafka_ingest_ts timestamp",
        [(1, 1000, 10, "click", "  ", 0, broker), (1, 1000, 10, "click", None, None, broker),
         (1, 1000, 10, "click", "kept", 5000, broker), (None, 1, 1, "click", "x", 1, broker)],
    )
    out = ingest.repair(df)
    made = out.select(ids.click_event_id(F.lit(1), F.lit(10), F.lit(1000), F.lit("click"))).first()[0]
    assert sorted(r["event_id"] for r in out.collect()) == sorted([made, made, "kept"])
    seconds = [r[0] for r in out.select(F.unix_seconds("ingest_ts")).collect()]
    assert seconds == [1768132800, 1768132800, 5]
    assert [r[0] for r in out.select(F.unix_millis("event_ts")).collect()] == [1000] * 3


def test_repair_accepts_timestamps(make):
    broker, early = at("2026-01-11T12:00:00"), at("2026-01-11T11:00:00")
    df = make("ingest_ts timestamp, kafka_ingest_ts timestamp",
              [(early, broker), (None, broker), (at("1970-01-01T00:00:00"), broker)])
    hours = [r[0] for r in ingest.fill_ingest_time(df).select(F.hour("ingest_ts")).collect()]
    assert hours == [11, 12, 12]


def test_late_split_and_rows_without_time(make):
    df = make("n string, event_ts timestamp",
              [("fresh", at("2026-01-11T11:58:00")), ("old", at("2026-01-11T11:30:00")),
               ("edge", at("2026-01-11T11:50:00")), ("none", None)])
    on_time, late = ingest.split_late(df, 10, NOW)
    assert [r[0] for r in rows(on_time, "n")] == ["edge", "fresh"]
    assert rows(late, "n") == [("old",)]
    assert rows(ingest.without_time(df), "n") == [("none",)]


def test_late_split_by_running_clock(spark):
    df = spark.range(1).select(
        F.explode(F.array(F.expr("current_timestamp() - interval 2 minutes"),
                          F.expr("current_timestamp() - interval 30 minutes"))).alias("event_ts"))
    on_time, late = ingest.split_late(df, 10)
    assert (on_time.count(), late.count()) == (1, 1)


def test_late_payload(make):
    t = at("2026-01-11T11:30:00")
    df = make("event_id string, session_id long, item_id long, event_type string, "
              "event_ts timestamp, kafka_ingest_ts timestamp", [("e", 1, 2, "click", t, t)])
    row = ingest.late_payload(df).first()
    body = json.loads(row["value"])
    assert row["key"] == "e"
    assert list(body) == ["event_id", "session_id", "item_id", "event_type", "event_ts",
                          "kafka_ingest_ts", "reason"]
    assert body["reason"] == "too_late"


CLICKS = "`Session ID` string, Timestamp string, `Item ID` string, Category string"


def test_parse_clicks(make):
    raw = make(CLICKS, [("12345", "2026-01-11T10:00:00+00:00", "42", "electronics"),
                        ("1", "2026-01-11T10:00:00Z", "42", "0"),
                        (None, "2026-01-11T10:00:00Z", None, None),
                        ("x", "2026-01-11T10:00:00Z", "42", "1"),
                        ("1", "yesterday", "42", "1"), ("1", "2026-01-11T10:00:00Z", "4.5", "1")])
    valid, rejects = ingest.split_valid(ingest.parse_clicks(raw, now=NOW))
    first, second = valid.orderBy(F.desc("session_id")).collect()
    assert (first["session_id"], first["item_id"], first["category"]) == (12345, 42, "electronics")
    assert first["source"] == "producer_clicks" and first["event_type"] == "click"
    expected = valid.select(
        ids.click_event_id(F.lit(12345), F.lit(42), F.lit(1768125600000), F.lit("click")))
    assert first["event_id"] == expected.first()[0]
    assert second["category"] is None
    assert rows(rejects, "error") == [
        ("Failed to parse row: bad item id",), ("Failed to parse row: bad session id",),
        ("Failed to parse row: bad timestamp",), ("Failed to parse row: missing required column",)]


def test_parse_clicks_with_other_headers(make):
    raw = make("sessionId string, event_ts string, item_id string, category string",
               [("7", "2026-01-11T10:00:00Z", "9", "")])
    valid, _ = ingest.split_valid(ingest.parse_clicks(raw))
    assert rows(valid, "session_id", "item_id", "category") == [(7, 9, None)]


def test_parse_purchases(make):
    raw = make("`Session ID` string, Timestamp string, `Item ID` string, Price string, Quantity string",
               [("1", "2026-01-11T10:00:00Z", "10", "12.5", "2"),
                ("1", "2026-01-11T10:00:00Z", "10", "free", "2"),
                ("1", "2026-01-11T10:00:00Z", "10", "1", "1.5")])
    parsed = ingest.parse_purchases(raw)
    valid, rejects = ingest.split_valid(parsed)
    row = valid.first()
    assert (float(row["price"]), row["quantity"]) == (12.5, 2)
    made = valid.select(ids.purchase_event_id(
        F.lit(1), F.lit(10), F.lit(1768125600000), F.lit(2), F.lit(12.5))).first()[0]
    assert row["event_id"] == made
    assert rows(rejects, "error") == [
        ("Failed to parse row: bad price",), ("Failed to parse row: bad quantity",)]


def test_dead_letter_envelope(make):
    raw = make(CLICKS, [("5", "", "42", None), (None, None, "1", "2")])
    _, rejects = ingest.split_valid(ingest.parse_clicks(raw))
    out = ingest.dead_letters(rejects, "loader", "clicks", now=NOW).orderBy("key").collect()
    assert [r["key"] for r in out] == [None, "5"]
    body = json.loads(out[1]["value"])
    assert list(body) == ["producer", "source_topic", "stage", "error", "timestamp",
                          "original_data", "event"]
    assert body["original_data"] == {"Session ID": "5", "Timestamp": "", "Item ID": "42",
                                     "Category": None}
    assert body["timestamp"] == "2026-01-11T12:00:00.000000+00:00"
    assert body["event"] is None and body["stage"] == "parse"


def test_shift_starts_at_now_and_keeps_gaps(make):
    df = make("event_ts timestamp", [(at("2014-04-01T03:00:05"),), (at("2014-04-01T03:00:00"),)])
    out = ingest.shift_to(df, NOW).select(F.col("event_ts").cast("string"))
    assert rows(out) == [("2026-01-11 12:00:00",), ("2026-01-11 12:00:05",)]


def test_batch_dedup_keeps_one_row_per_id(make):
    df = make("event_id string, n int", [("a", 1), ("a", 1), ("b", 2)])
    assert rows(ingest.drop_duplicate_events(df)) == [("a", 1), ("b", 2)]


def test_stamp_adds_the_clock(make):
    out = ingest.stamp(make("n int", [(1,)]), "created_at", "updated_at").first()
    assert out["created_at"] == out["updated_at"]
