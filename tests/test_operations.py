"""Alerts, runs, quality, progress reports, SLO."""

import datetime as dt
import json

import pytest
from support import at, rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import ops, progress, quality, slo
from millrace.sources.progress_log import parse_progress_lines, progress_rows

SNAPSHOT = "topic string, snapshot_ts timestamp, partition int, end_offset long"
T = [at(f"2026-01-11T10:{m:02d}:00") for m in (0, 5, 7, 12, 20)]


@pytest.fixture
def growth(make):
    data = [("dlq", T[0], 0, 5), ("dlq", T[0], 1, 5), ("dlq", T[1], 0, 6), ("dlq", T[1], 1, 5),
            ("dlq", T[2], 0, 30), ("dlq", T[2], 1, 11), ("dlq", T[3], 0, 20), ("dlq", T[3], 1, 11),
            ("dlq", T[4], 0, 20), ("dlq", T[4], 1, 11)]
    return ops.dlq_growth(make(SNAPSHOT, data))


def test_growth_is_never_negative(growth):
    out = growth.orderBy("snapshot_ts").collect()
    assert [r["growth"] for r in out] == [10, 1, 30, 0, 0]
    assert out[2]["offsets"] == {"dlq:0": 30, "dlq:1": 11}


def test_severity_levels(make):
    df = make("g long", [(0,), (1,), (19,), (20,)])
    assert [r[0] for r in df.select(ops.severity(F.col("g"))).collect()] == [
        "NONE", "WARNING", "WARNING", "CRITICAL"]


def test_alerts_once_per_bucket_and_not_again(growth):
    first = ops.alert_rows(growth)
    assert rows(first, "severity", "message") == [
        ("CRITICAL", "dlq: 30 more dead letters (critical)"),
        ("WARNING", "dlq: 1 more dead letters (warning)"),
        ("WARNING", "dlq: 10 more dead letters (warning)")]
    assert ops.alert_rows(growth.unionByName(growth)).count() == 3
    assert ops.alert_rows(growth, first).count() == 0
    assert {r["time_bucket"] for r in first.collect()} == {first.first()["time_bucket"]}


def test_run_history(make):
    day = dt.date(2026, 1, 11)
    runs = make("run_id string, run_date date", [("a", day), ("b", day)])
    started = ops.run_started(runs, "batch", F.lit(T[0]))
    ended = ops.run_ended(started.filter("run_id = 'a'"), "SUCCESS", 42, at=F.lit(T[1]))
    out = ops.latest_runs(started.unionByName(ended))
    assert rows(out, "run_id", "status", "records_processed") == [
        ("a", "SUCCESS", 42), ("b", "RUNNING", None)]
    assert out.columns == [f.name for f in schemas.PIPELINE_RUNS.fields]


def test_retention_frames(make):
    df = make("d date", [(dt.date(2026, 1, d),) for d in (1, 2, 2, 5)])
    assert ops.kept(df, "d", "2026-01-12", 10).count() == 3
    assert rows(ops.expired_dates(df, "d", "2026-01-12", 10)) == [(dt.date(2026, 1, 1), 1)]


def test_duplicate_keys(make):
    df = make("a int, b int", [(1, 1), (1, 1), (1, 2)])
    assert rows(ops.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_quality_results(make):
    df = make("id string, n int, rate double", [("a", 1, 0.5), ("a", -1, 1.5), (None, 2, None)])
    rules = [quality.min_rows(3), quality.min_rows(4), quality.null_rate("id", 0.5),
             quality.null_rate("id", 0.1, "WARNING"), quality.no_duplicates("id"),
             quality.domain("n", F.col("n") < 0),
             quality.schema_drift(df, make("id string, n long, extra int", []).schema)]
    out = quality.quality_checks(df, "t", rules, "2026-01-11").collect()
    assert [r["check_result"] for r in out] == [
        "PASS", "FAIL", "PASS", "WARNING", "FAIL", "FAIL", "FAIL"]
    assert [r["actual_value"] for r in out] == [3.0, 3.0, 1 / 3, 1 / 3, 1.0, 1.0, 3.0]
    assert list(out[0].asDict()) == [f.name for f in schemas.QUALITY_CHECKS.fields]


def test_quality_of_an_empty_table(make):
    df = make("id string", [])
    out = quality.quality_checks(
        df, "t", [quality.min_rows(), quality.null_rate("id"), quality.no_duplicates("id")], "2026-01-11")
    assert [r["check_result"] for r in out.collect()] == ["FAIL", "PASS", "PASS"]


def record(name, batch, start, end, second, rows_in=10, ms=500, lag=0, state=5, run="r"):
    return json.dumps({
        "event": "query_progress", "name": name, "runId": run, "batchId": batch,
        "timestamp": f"2026-01-11T10:00:{second:02d}.000Z", "numInputRows": rows_in,
        "processedRowsPerSecond": 12.345, "durationMs": {"triggerExecution": ms, "other": 1},
        "sources": [{"description": "k", "startOffset": {"clicks": start} if start else None,
                     "endOffset": {"clicks": end}, "metrics": {"maxOffsetsBehindLatest": str(lag)}}],
        "stateOperators": [{"numRowsTotal": state}, {"numRowsTotal": 1}]})


@pytest.fixture
def log(make):
    lines = [
        record("hf", 0, {"0": 0, "1": 0}, {"0": 5, "1": 5}, 0),
        record("hf", 1, {"0": 5, "1": 5}, {"0": 9, "1": 9}, 10, rows_in=12, ms=1500, lag=3),
        record("hf", 2, {"0": 9, "1": 9}, {"0": 9, "1": 12}, 30, rows_in=3, ms=1000, state=8),
        record("bot", 0, {"0": 0, "1": 0}, {"0": 5, "1": 5}, 0),
        record("bot", 1, {"0": 6, "1": 5}, {"0": 9, "1": 12}, 40, ms=7000, run="r2"),
        "not json", json.dumps({"event": "query_started", "name": "hf"})]
    return progress_rows(parse_progress_lines(make("value string", [(x,) for x in lines])), "clicks")


def test_progress_summary(log):
    out = {r["name"]: r for r in progress.progress_summary(log).collect()}
    hf = out["hf"]
    assert (hf["batches"], hf["input_rows"], hf["processed_rows_per_second_max"]) == (3, 25, 12.35)
    assert (hf["trigger_ms_p95"], hf["trigger_ms_max"]) == (1450.0, 1500.0)
    assert (hf["lag_max"], hf["lag_end"], hf["state_rows_end"]) == (3, 0, 9)


def test_offset_continuity(log):
    out = {r["name"]: r for r in progress.offset_continuity(log).collect()}
    assert out["hf"]["offsets_contiguous"] and not out["bot"]["offsets_contiguous"]
    assert (out["hf"]["logical_offset_span"], out["hf"]["input_rows_retry_overcount"]) == (21, 4)
    assert out["bot"]["run_ids"] == ["r", "r2"]
    initial = F.create_map(F.lit("0"), F.lit(0).cast("long"), F.lit("1"), F.lit(0).cast("long"))
    other = F.create_map(F.lit("0"), F.lit(1).cast("long"), F.lit("1"), F.lit(0).cast("long"))
    hf = log.filter("name = 'hf'")
    assert progress.offset_continuity(hf, initial).first()["offsets_contiguous"]
    assert not progress.offset_continuity(hf, other).first()["offsets_contiguous"]


def test_recovery(log):
    final = F.create_map(F.lit("0"), F.lit(9).cast("long"), F.lit("1"), F.lit(12).cast("long"))
    fault = "2026-01-11 10:00:05"
    out = {r["name"]: r for r in progress.query_recovery(log, fault, final).collect()}
    seconds = lambda t: t.second + t.microsecond / 1e6
    assert seconds(out["hf"]["first_batch_after_fault_at"]) == 11.5
    assert seconds(out["hf"]["final_offsets_reached_at"]) == 31.0
    row = progress.recovery_time(log, fault, final, 2).first()
    assert (row["queries_recovered"], row["recovery_seconds"]) == (2, 42.0)
    missing = progress.recovery_time(log.filter("name = 'hf'"), fault, final, 2).first()
    assert missing["recovery_seconds"] is None
    beyond = F.create_map(F.lit("2"), F.lit(1).cast("long"))
    assert progress.recovery_time(log, fault, beyond).first()["queries_recovered"] == 0


def test_capacity_checks(log):
    summary = progress.progress_summary(log)
    found = progress.capacity_checks(summary, ["hf", "bot", "late_events"])
    failed = {(r["name"], r["rule"]): r["passed"] for r in found.collect()}
    assert all(failed[("hf", rule)] for rule in ("progress", "lag", "trigger_p95"))
    assert failed[("bot", "trigger_p95")] is False
    assert failed[("late_events", "progress")] is False
    assert ("late_events", "trigger_p95") not in failed


def test_slo(make):
    schema = ("event_ts long, detected_at timestamp, kafka_ingest_ts timestamp, "
              "spark_process_ts timestamp, db_write_ts timestamp")
    base = at("2026-01-11T10:00:00")
    ms = lambda n: base + dt.timedelta(milliseconds=n)
    data = [(int(base.timestamp() * 1000), base, ms(i), ms(3 * i), ms(6 * i)) for i in range(101)]
    data += [(0, base, None, base, base), (0, at("2026-01-01T00:00:00"), base, base, base)]
    df = make(schema, data)
    row = slo.slo_latency(df, "2026-01-12").first()
    assert tuple(row) == (101, 50.0, 100.0, 150.0, 300.0, 570.0, 594.0)
    report = json.loads(slo.slo_report(df, "2026-01-12").first()[0])
    assert report["window_hours"] == 24 and report["report"]["samples"] == 101
    empty = slo.slo_latency(df, "2030-01-01").first()
    assert empty["samples"] == 0 and empty["p99_e2e_ms"] is None
