"""A third of all rows on one session, one item and one event id."""

import datetime as dt
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from support import rows
from pyspark.sql import functions as F

from millrace.operators import activity, daily, funnel, ingest, items

DAY = dt.date(2026, 1, 11)
ROWS = 30_000


@pytest.fixture(scope="module")
def events(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(0, ROWS, 1, 4).select(
        F.lit(DAY).alias("metric_date"),
        F.when(hot, 0).otherwise(1 + F.col("id") % 997).cast("long").alias("session_id"),
        F.when(hot, 7).otherwise(F.col("id") % 211).cast("long").alias("item_id"),
        F.concat(F.lit("c"), (F.col("id") % 13).cast("string")).alias("category"),
        F.col("id").alias("event_ms"),
        F.when(F.col("id") % 10 == 9, "purchase").otherwise("click").alias("kind"),
        (F.col("id") % 50).cast("decimal(12,2)").alias("price"),
        F.lit(2).alias("quantity"),
        F.when(hot, "same").otherwise(F.col("id").cast("string")).alias("event_id"),
    )


@pytest.fixture(scope="module")
def local(events):
    return [r.asDict() for r in events.collect()]


def test_reports_on_a_crowded_session_and_item(events, local):
    act = activity.activity_from_events(events)
    clicks = [r for r in local if r["kind"] == "click"]
    bought = [r for r in local if r["kind"] == "purchase"]
    per_session = defaultdict(list)
    for r in clicks:
        per_session[r["session_id"]].append(r["event_ms"])

    row = daily.daily_metrics(act).first()
    assert (row["total_clicks"], row["total_purchases"]) == (len(clicks), len(bought))
    assert row["unique_sessions"] == len(per_session)
    assert row["unique_items"] == len({r["item_id"] for r in clicks})
    assert row["total_revenue"] == sum(r["price"] * 2 for r in bought)
    spans = [max(v) - min(v) for v in per_session.values()]
    assert row["avg_session_duration_sec"] == sum(spans) / 1000 / len(spans)

    stages = {r["funnel_stage"]: r["session_count"] for r in funnel.session_funnel(act).collect()}
    assert stages == {
        "VIEW": len(per_session),
        "MULTI_VIEW": sum(len(v) > 1 for v in per_session.values()),
        "PURCHASE": len({r["session_id"] for r in bought} & set(per_session)),
    }

    count, revenue = Counter(r["item_id"] for r in clicks), defaultdict(Decimal)
    for r in bought:
        revenue[r["item_id"]] += r["price"] * 2
    best = sorted(count, key=lambda i: (-revenue[i], i))[:10]
    top = items.popular_items(act, 10).orderBy("rank").collect()
    assert [(r["item_id"], r["click_count"], r["revenue"]) for r in top] == [
        (i, count[i], revenue[i]) for i in best]


def test_copies_of_one_event(events, local):
    kept = ingest.drop_duplicate_events(events.select("event_id"))
    assert rows(kept) == sorted(((i,) for i in {r["event_id"] for r in local}), key=repr)
