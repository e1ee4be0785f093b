"""Daily metrics, items, categories, funnel, session summary."""

import datetime as dt
from decimal import Decimal

import pytest
from support import rows
from pyspark.sql import functions as F

from millrace.operators import activity, daily, funnel, items, sessions

DAY = dt.date(2026, 1, 11)
CLICK = "metric_date date, session_id long, event_ms long, item_id long, category string"
BUY = "metric_date date, session_id long, event_ms long, item_id long, price decimal(12,2), quantity int"


@pytest.fixture
def clicks(make):
    return make(CLICK, [(DAY, 1, 1000000, 10, "electronics"), (DAY, 1, 1005000, 20, "electronics"),
                        (DAY, 2, 1010000, 10, "books")])


@pytest.fixture
def purchases(make):
    return make(BUY, [(DAY, 1, 1002000, 10, Decimal(5000), 2)])


@pytest.fixture
def nothing(make):
    return make(BUY, [])


def test_daily_metrics(clicks, purchases):
    row = daily.daily_metrics(activity.activity(clicks, purchases)).first().asDict()
    assert row == {
        "metric_date": DAY, "total_clicks": 3, "total_purchases": 1, "unique_sessions": 2,
        "unique_items": 2, "conversion_rate": 0.5, "avg_session_duration_sec": 2.5,
        "avg_clicks_per_session": 1.5, "total_revenue": Decimal("10000.00"),
        "avg_order_value": 10000.0,
    }


def test_daily_metrics_without_purchases(clicks, nothing):
    row = daily.daily_metrics(activity.activity(clicks, nothing)).first()
    assert (row["total_purchases"], row["conversion_rate"], row["avg_order_value"]) == (0, 0.0, 0.0)
    assert row["total_revenue"] is None


def test_days_without_clicks_have_no_row(clicks, make):
    other = make(BUY, [(DAY + dt.timedelta(days=1), 9, 1, 10, Decimal(1), 1)])
    assert rows(daily.daily_metrics(activity.activity(clicks, other)).select("metric_date")) == [
        (DAY,)]


def test_conversion_is_not_clamped(make, clicks):
    buyers = make(BUY, [(DAY, s, 1, 10, Decimal(1), 1) for s in range(5)])
    row = daily.daily_metrics(activity.activity(clicks, buyers)).first()
    assert row["conversion_rate"] == 2.5


def test_single_operators_agree_with_the_report(clicks, purchases):
    report = daily.daily_metrics(activity.activity(clicks, purchases)).first()
    totals = daily.click_totals(clicks).first()
    assert (totals["total_clicks"], totals["unique_sessions"], totals["unique_items"]) == (3, 2, 2)
    averages = daily.session_averages(clicks).first()
    assert averages["avg_session_duration_sec"] == report["avg_session_duration_sec"]
    assert averages["avg_clicks_per_session"] == report["avg_clicks_per_session"]
    bought = daily.purchase_totals(purchases).first()
    assert (bought["total_purchases"], bought["purchase_sessions"]) == (1, 1)
    assert bought["total_revenue"] == Decimal("10000.00")
    assert rows(daily.click_sessions(clicks), "session_id", "duration_sec") == [(1, 5.0), (2, 0.0)]


@pytest.fixture
def item_clicks(make):
    data = [(1, 10, "electronics"), (2, 10, "electronics"), (3, 10, "electronics"),
            (4, 20, "books"), (5, 20, "books"), (6, 30, "sports")]
    return make(CLICK, [(DAY, s, 1, i, c) for s, i, c in data])


@pytest.fixture
def item_purchases(make):
    data = [(10, 5000, 1), (10, 5000, 2), (20, 3000, 1)]
    return make(BUY, [(DAY, 1, 1, i, Decimal(p), q) for i, p, q in data])


def test_item_counts_and_ranking(item_clicks, item_purchases):
    assert rows(items.clicks_per_item(item_clicks), "item_id", "click_count") == [
        (10, 3), (20, 2), (30, 1)]
    top = items.popular_items(activity.activity(item_clicks, item_purchases))
    assert rows(top, "rank", "item_id", "category", "revenue", "click_to_purchase_ratio") == [
        (1, 10, "electronics", Decimal("15000.00"), 1.5),
        (2, 20, "books", Decimal("3000.00"), 2.0),
        (3, 30, "sports", Decimal("0.00"), None)]
    two = items.popular_items(activity.activity(item_clicks, item_purchases), 2)
    assert two.count() == 2


def test_ties_are_broken_by_item(make, nothing):
    same = make(CLICK, [(DAY, 1, 1, i, "a") for i in (7, 5, 6)])
    top = items.popular_items(activity.activity(same, nothing), 2)
    assert rows(top, "rank", "item_id") == [(1, 5), (2, 6)]


@pytest.mark.parametrize(
    ("categories", "expected"),
    [(["b", "a"], "a"), ([None, "b"], "b"), ([None, None, "b"], None), (["b", "b", "a"], "b"),
     ([None], None)],
)
def test_primary_category(make, nothing, categories, expected):
    df = make(CLICK, [(DAY, 1, 1, 5, c) for c in categories])
    assert items.primary_category(df).first()["category"] == expected
    top = items.popular_items(activity.activity(df, nothing)).first()
    assert top["category"] == expected


def test_items_only_bought_are_left_out(make, item_clicks):
    bought = make(BUY, [(DAY, 1, 1, 99, Decimal(5), 1)])
    top = items.popular_items(activity.activity(item_clicks, bought))
    assert 99 not in [r["item_id"] for r in top.collect()]


def test_categories(item_clicks, item_purchases):
    out = items.popular_categories(item_clicks, item_purchases)
    assert rows(out, "rank", "category", "click_count", "unique_items", "purchase_count") == [
        (1, "electronics", 3, 1, 2), (2, "books", 2, 1, 1), (3, "sports", 1, 1, 0)]


def test_purchases_count_in_each_clicked_category(make):
    clicks = make(CLICK, [(DAY, 1, 1, 5, "a"), (DAY, 2, 1, 5, "a"), (DAY, 3, 1, 5, "b"),
                          (DAY, 4, 1, 5, None)])
    bought = make(BUY, [(DAY, 1, 1, 5, Decimal(10), 1)])
    every = items.popular_categories(clicks, bought)
    assert rows(every, "category", "click_count", "purchase_count") == [("a", 2, 1), ("b", 1, 1)]
    primary = items.popular_categories(clicks, bought, attribution="primary")
    assert rows(primary, "category", "click_count", "purchase_count") == [("a", 2, 1), ("b", 1, 0)]
    with pytest.raises(ValueError):
        items.category_purchases(clicks, bought, "none")


def test_category_fanout_equals_row_by_row_join(make):
    """Summing per item before the join gives the same as joining every purchase."""
    clicks = make(CLICK, [(DAY, s, 1, s % 4, "abc"[s % 3]) for s in range(40)])
    bought = make(BUY, [(DAY, s, 1, s % 5, Decimal(s), 1 + s % 2) for s in range(50)])
    pairs = clicks.select("metric_date", "item_id", "category").distinct()
    naive = bought.join(pairs, ["metric_date", "item_id"]).groupBy("metric_date", "category").agg(
        F.count("*").alias("purchase_count"), F.sum(F.col("price") * F.col("quantity")).alias("revenue"))
    assert rows(items.category_purchases(clicks, bought)) == rows(naive)


@pytest.fixture
def funnel_input(make):
    clicks = make(CLICK, [(DAY, s, 1, i, "a") for s, i in
                          [(1, 10), (1, 20), (2, 10), (2, 30), (3, 40), (4, 50)]])
    return clicks, make(BUY, [(DAY, 1, 1, 10, Decimal(1), 1)])


def test_funnel(funnel_input):
    out = funnel.session_funnel(activity.activity(*funnel_input))
    assert rows(out, "funnel_stage", "session_count", "percentage", "drop_rate") == [
        ("MULTI_VIEW", 2, 50.0, 0.5), ("PURCHASE", 1, 25.0, 0.5), ("VIEW", 4, 100.0, 0.0)]


def test_funnel_drop_can_be_negative_and_buyers_need_a_click(make):
    clicks = make(CLICK, [(DAY, 1, 1, 1, "a"), (DAY, 2, 1, 1, "a"), (DAY, 2, 1, 1, "a")])
    bought = make(BUY, [(DAY, s, 1, 1, Decimal(1), 1) for s in (1, 2, 3)])
    out = {r["funnel_stage"]: r for r in
           funnel.session_funnel(activity.activity(clicks, bought)).collect()}
    assert out["PURCHASE"]["session_count"] == 2
    assert out["PURCHASE"]["drop_rate"] == -1.0


def test_funnel_without_multi_view(make, nothing):
    clicks = make(CLICK, [(DAY, 1, 1, 1, "a")])
    out = funnel.session_funnel(activity.activity(clicks, nothing))
    assert rows(out, "funnel_stage", "drop_rate") == [
        ("MULTI_VIEW", 1.0), ("PURCHASE", 0.0), ("VIEW", 0.0)]


def test_funnel_sessions(funnel_input):
    out = funnel.funnel_sessions(activity.activity(*funnel_input))
    assert rows(out, "session_id", "click_count", "unique_items_viewed", "has_purchase") == [
        (1, 2, 2, True), (2, 2, 2, False), (3, 1, 1, False), (4, 1, 1, False)]


def test_session_summary(clicks, purchases, make):
    odd = make("session_id long", [(2,), (2,), (77,)])
    out = sessions.session_summary(activity.activity(clicks, purchases), odd)
    first, second = out.orderBy("session_id").collect()
    assert (first["duration_sec"], first["click_count"], first["purchase_count"]) == (5, 2, 1)
    assert (first["unique_items_viewed"], first["unique_items_purchased"]) == (2, 1)
    assert first["total_spent"] == Decimal("10000.00")
    assert (first["is_converted"], first["is_anomaly"]) == (True, False)
    assert first["categories_viewed"] == ["electronics"]
    assert (second["is_converted"], second["is_anomaly"]) == (False, True)
    assert second["categories_viewed"] == ["books"]


def test_file_totals(make):
    df = make("price decimal(12,2), quantity int, event_ts timestamp",
              [(Decimal("1.50"), 2, dt.datetime(2026, 1, 1)), (Decimal("2"), 1, dt.datetime(2026, 1, 2))])
    row = daily.file_totals(df).first()
    assert (row["events"], row["total_revenue"]) == (2, Decimal("5.00"))


@pytest.mark.parametrize("n", [3, 30, 1500])
def test_rankings_are_sliced_first(make, n):
    """Below and above the bound that Spark trims by itself."""
    data = [(k % 2, k * 7 % 50, k) for k in range(4000)]
    df = make("g int, v long, i long", data).repartition(5)
    order = [F.col("v").desc(), F.col("i").asc()]
    wanted = []
    for g in (0, 1):
        group = sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
        wanted += [(*r, place) for place, r in enumerate(group, 1)]
    assert rows(items.top_n(df, ["g"], order, n)) == sorted(wanted, key=repr)
