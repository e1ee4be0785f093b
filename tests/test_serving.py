"""Serving queries and views on small tables."""

import datetime as dt
from decimal import Decimal

import pytest
from support import at, rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import serving

AS_OF = "2026-01-12 00:00:00"
D = dt.date


def anomaly(i, session, kind, score, when, clicks=60):
    t = at(when)
    return (f"e{i}", 0, session, t, t, t, t, t + dt.timedelta(seconds=9), clicks, 3, score, kind, t, t, "s")


@pytest.fixture
def anomalies(make):
    return make(schemas.ANOMALY, [
        anomaly(1, 1, "HIGH_FREQUENCY", 1.2, "2026-01-11T10:10:00"),
        anomaly(2, 1, "BOT_LIKE", 1.5, "2026-01-11T10:50:00", 90),
        anomaly(3, 2, "BOT_LIKE", 2.5, "2026-01-11T11:10:00"),
        anomaly(4, 2, "BOT_LIKE", 3.5, "2026-01-09T11:10:00")])


@pytest.fixture
def daily(make):
    def day(d, clicks, rate, revenue, purchases=2):
        return (d, clicks, purchases, 10, 5, rate, 90.125, 1.005, Decimal(revenue), 7.125)

    return make(schemas.DAILY_METRICS, [
        day(D(2026, 1, 1), 1, 0.1, "10.00"), day(D(2026, 1, 10), 10, 0.03125, "20.50"),
        day(D(2026, 1, 11), 20, 0.5, "30.25", 0), day(D(2025, 11, 1), 5, 0.2, "1.00")])


@pytest.fixture
def funnel(make):
    return make(schemas.SESSION_FUNNEL, [
        (d, s, n, p, q) for d in (D(2026, 1, 10), D(2026, 1, 11)) for s, n, p, q in
        [("PURCHASE", 1, 33.3333333, 0.12345), ("VIEW", 3, 100.0, 0.0), ("MULTI_VIEW", 2, 66.6666667, 0.3)]])


@pytest.fixture
def items(make):
    def item(d, i, rank, revenue, category="a", ratio=1.005):
        return (d, i, category, 10, 2, Decimal(revenue), rank, ratio)

    return make(schemas.POPULAR_ITEMS, [
        item(D(2026, 1, 10), 1, 1, "50"), item(D(2026, 1, 10), 2, 2, "40", None, None),
        item(D(2026, 1, 11), 1, 2, "5"), item(D(2026, 1, 11), 2, 1, "60"),
        item(D(2025, 12, 1), 9, 1, "999")])


def test_recent_anomalies(anomalies):
    ids = lambda df: [r["event_id"] for r in df.collect()]
    assert ids(serving.recent_anomalies(anomalies)) == ["e3", "e2", "e1", "e4"]
    assert ids(serving.recent_anomalies(anomalies, 2)) == ["e3", "e2"]
    assert ids(serving.recent_anomalies(anomalies, 10, "BOT_LIKE", 2.5)) == ["e3", "e4"]
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            serving.recent_anomalies(anomalies, limit)


def test_anomaly_types(anomalies):
    assert [tuple(r)[:3] for r in serving.anomaly_types(anomalies).collect()] == [
        ("BOT_LIKE", 3, 2.5), ("HIGH_FREQUENCY", 1, 1.2)]


def test_timeline(anomalies):
    out = serving.anomaly_timeline(anomalies, AS_OF)
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 1, 2.5), (2, 1, 1.35)]
    with pytest.raises(ValueError):
        serving.anomaly_timeline(anomalies, AS_OF, 169)


def test_session_lookup(anomalies):
    assert [r["event_id"] for r in serving.anomalies_for_session(anomalies, 2).collect()] == ["e3", "e4"]
    assert serving.anomalies_for_session(anomalies, 99).isEmpty()


def test_recent_view(anomalies):
    out = serving.view_recent_anomalies(anomalies, AS_OF)
    assert [(r["event_id"], r["window_duration_minutes"]) for r in out.collect()] == [
        ("e3", 0.15), ("e2", 0.15), ("e1", 0.15)]


def test_daily_range_rounds(daily):
    out = serving.daily_metrics_range(daily, "2026-01-10", "2026-01-11").collect()
    assert [r["conversion_rate"] for r in out] == [0.0313, 0.5]
    assert (out[0]["avg_session_duration_sec"], out[0]["avg_clicks_per_session"]) == (90.13, 1.01)
    assert out[0]["avg_order_value"] == 7.13
    with pytest.raises(ValueError):
        serving.daily_metrics_range(daily, "2026-01-11", "2026-01-10")
    assert serving.daily_metrics_for(daily, "2026-01-11").count() == 1
    assert serving.daily_metrics_for(daily, "2026-01-20").isEmpty()


def test_summary(daily):
    row = serving.metrics_summary(daily, "2026-01-12", 7).first()
    assert (row["days_processed"], row["total_clicks"], row["total_revenue"]) == (2, 30, 51)
    assert row["avg_conversion_rate"] == 0.2656
    nothing = serving.metrics_summary(daily, "2030-01-01", 7).first()
    assert nothing["days_processed"] == 0 and nothing["avg_conversion_rate"] is None


def test_daily_view(daily):
    out = serving.view_daily_summary(daily, "2026-01-12").collect()
    assert [r["metric_date"].day for r in out] == [11, 10, 1]
    assert (out[0]["conversion_rate_pct"], out[0]["avg_order_value"]) == (50.0, 0.0)
    assert (out[1]["conversion_rate_pct"], out[1]["avg_order_value"]) == (3.13, 10.25)
    assert out[1]["avg_session_duration_minutes"] == 1.5


def test_funnel_order(funnel):
    out = serving.funnel_for(funnel, "2026-01-11").collect()
    assert [(r["funnel_stage"], r["percentage"]) for r in out] == [
        ("VIEW", 100.0), ("MULTI_VIEW", 66.67), ("PURCHASE", 33.33)]
    assert out[2]["drop_rate"] == 0.1235
    latest = serving.view_latest_funnel(funnel).collect()
    assert [r["funnel_stage"] for r in latest] == ["VIEW", "MULTI_VIEW", "PURCHASE"]
    assert latest[2]["drop_rate_pct"] == 12.35


def test_items_for_date(items):
    out = serving.popular_items_for(items, "2026-01-10", 1).collect()
    assert [(r["item_id"], r["click_to_purchase_ratio"]) for r in out] == [(1, 1.01)]
    second = serving.popular_items_for(items, "2026-01-10").collect()[1]
    assert (second["category"], second["click_to_purchase_ratio"]) == (None, None)


def test_trending(items):
    out = serving.trending_items(items, "2026-01-12").collect()
    assert [(r["item_id"], r["category"], float(r["total_revenue"]), r["avg_rank"]) for r in out] == [
        (2, "a", 60.0, 1.0), (1, "a", 55.0, 1.5), (2, None, 40.0, 2.0)]
    assert serving.view_top_items(items, "2026-01-12").count() == 3


def test_categories_for_date(make):
    df = make(schemas.POPULAR_CATEGORIES, [
        (D(2026, 1, 10), c, 1, 1, 1, Decimal(1), r) for r, c in enumerate("abc", 1)])
    out = serving.popular_categories_for(df, "2026-01-10", 2)
    assert [r["category"] for r in out.collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        serving.popular_categories_for(df, "2026-01-10", 101)


def test_system_stats_and_health(anomalies, daily, items):
    row = serving.system_stats(anomalies, daily, items).first()
    assert (row["total_anomalies"], row["days_processed"], row["total_popular_items"]) == (4, 4, 5)
    assert row["last_metrics_date"] == D(2026, 1, 11)
    stamped = [df.withColumn("created_at", F.lit(at("2026-01-11T00:00:00"))) for df in (daily, items)]
    out = serving.system_health(anomalies, *stamped)
    assert rows(out, "table_name", "row_count") == [
        ("anomaly_sessions", 4), ("daily_metrics", 4), ("popular_items", 5)]


def test_dashboard_tiles(anomalies, daily):
    assert tuple(serving.anomaly_tiles(anomalies).first()) == (4, 2.18, 90)
    tiles = serving.daily_tiles(daily.filter("metric_date >= '2026-01-10'")).first()
    assert (tiles["total_clicks"], tiles["avg_conversion"]) == (30, 0.2656)
    assert tuple(serving.score_quartiles(anomalies).first()) == (1.2, 1.425, 2.0, 2.75, 3.5)


def test_limits_become_a_bounded_top_k(anomalies):
    plan = serving.recent_anomalies(anomalies, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
