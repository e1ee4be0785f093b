"""The command line on small files."""

import datetime as dt
import json
from pathlib import Path

import pytest
from support import rows

from millrace import cli
from millrace.sources import lake
from millrace.sources.tables import read_table
from millrace.sinks.anomalies import stored_schema

CLICKS = ("Session ID,Timestamp,Item ID,Category\n"
          "1,2014-04-07T10:51:09.277Z,214,S\n1,2014-04-07T10:54:09.868Z,215,0\n"
          "2,2014-04-07T13:56:37.614Z,214,5\n2,2014-04-08T00:00:00.000Z,214,5\nx,y,z,0\n")
BUYS = ("Session ID,Timestamp,Item ID,Price,Quantity\n"
        "1,2014-04-07T10:59:00.000Z,214,12462,1\n")


@pytest.fixture
def loaded(spark, folder):
    Path(f"{folder}/clicks.csv").write_text(CLICKS)
    Path(f"{folder}/buys.csv").write_text(BUYS)
    for name, kind in (("clicks", "click"), ("buys", "purchase")):
        cli.main(["load", f"{folder}/{name}.csv", kind, "2014-04-07", "2026-01-11",
                  "--lake", f"{folder}/lake"], spark)
    return folder


def test_load_moves_one_day(spark, loaded):
    stored = lake.read_events(spark, f"{loaded}/lake", "click")
    assert rows(stored, "session_id", "item_id", "category", "dt", "hour") == [
        (1, 214, "S", dt.date(2026, 1, 11), 10), (1, 215, None, dt.date(2026, 1, 11), 10),
        (2, 214, "5", dt.date(2026, 1, 11), 13)]


def test_daily(spark, loaded, capsys):
    cli.main(["daily", "2026-01-11", "--lake", f"{loaded}/lake", "--tables", f"{loaded}/t",
              "--top-n", "1"], spark)
    assert "popular_items: 1 rows" in capsys.readouterr().out
    daily = read_table(spark, f"{loaded}/t", "daily_metrics").first()
    assert (daily["total_clicks"], daily["conversion_rate"]) == (3, 0.5)
    cli.main(["daily", "2026-01-11", "--lake", f"{loaded}/lake", "--tables", f"{loaded}/only",
              "--only", "session_funnel"], spark)
    assert not Path(f"{loaded}/only/daily_metrics").exists()
    with pytest.raises(SystemExit):
        cli.main(["daily", "11.01.2026", "--lake", "x", "--tables", "y"], spark)


def test_sort(spark, folder):
    Path(f"{folder}/c.csv").write_text("Timestamp,n\n2014-04-08,2\n2014-04-07,1\n")
    cli.main(["sort", f"{folder}/c.csv", f"{folder}/out"], spark)
    lines = [line for f in sorted(Path(f"{folder}/out").glob("part-*")) for line in
             f.read_text().splitlines()]
    assert [line for line in lines if not line.startswith("T")] == ["2014-04-07,1", "2014-04-08,2"]


def test_slo(spark, make, folder, capsys):
    cli.main(["slo", "--tables", folder, "--as-of", "2026-01-11"], spark)
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["report"]["samples"] == 0
    assert "db_write_ts" in stored_schema().fieldNames()


def test_ingest_is_exact_and_routes_rejects(spark, folder):
    Path(f"{folder}/in").mkdir()
    Path(f"{folder}/in/a.csv").write_text(CLICKS)
    for _ in range(2):
        cli.main(["ingest", f"{folder}/in", "click", "--lake", f"{folder}/lake",
                  "--checkpoint", f"{folder}/cp", "--once"], spark)
    assert lake.read_events(spark, f"{folder}/lake", "click").count() == 4
    assert spark.read.parquet(f"{folder}/lake/dead_letters/click").count() == 1


def test_sessions_and_expiry(spark, loaded, capsys):
    cli.main(["sessions", "2026-01-11", "--lake", f"{loaded}/lake", "--tables", f"{loaded}/t"], spark)
    stored = read_table(spark, f"{loaded}/t", "session_summary")
    assert rows(stored, "session_id", "click_count", "is_converted", "is_anomaly") == [
        (1, 2, True, False), (2, 1, False, False)]
    cli.main(["expire", "session_summary", "--tables", f"{loaded}/t", "--as-of", "2026-03-01"], spark)
    assert "metric_date=2026-01-11: DROPPED" in capsys.readouterr().out


def test_a_repeated_load_replaces_its_rows(spark, loaded):
    cli.main(["load", f"{loaded}/clicks.csv", "click", "2014-04-07", "2026-01-11",
              "--lake", f"{loaded}/lake"], spark)
    cli.main(["load", f"{loaded}/clicks.csv", "click", "2014-04-07", "2026-01-12",
              "--lake", f"{loaded}/lake"], spark)
    stored = lake.read_events(spark, f"{loaded}/lake", "click")
    assert (stored.count(), stored.select("event_id").distinct().count()) == (6, 6)
    letters = spark.read.parquet(f"{loaded}/lake/dead_letters/click")
    assert letters.count() == 1
