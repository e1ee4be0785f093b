"""Heavy-hitter sketches of items against exact counts."""

from pyspark.sql import functions as F
from support import at, rows

from millrace.operators import trending
from millrace.sinks import published
from millrace.streaming import jobs

CLICK = "item_id long, event_ts timestamp"
NOON = at("2026-01-11T12:00:00")


def test_counts_are_exact_while_all_items_fit(make):
    data = [(1, NOON)] * 3 + [(2, NOON)] * 3 + [(3, NOON)] + [(None, NOON), (4, None)]
    data += [(2, at("2026-01-11T13:00:00"))]
    sketches = trending.item_sketches(make(CLICK, data))
    assert sketches.count() == 2
    found = trending.trending(sketches, limit=2)
    assert rows(found) == [(1, 3, 2, 8, 0), (2, 4, 1, 8, 0)]
    by_hour = trending.trending(sketches, "bucket", limit=1)
    assert rows(by_hour, "item_id", "clicks", "group_clicks") == [(1, 3, 7), (2, 1, 1)]


def test_empty_input_has_no_items(make):
    sketches = trending.item_sketches(make(CLICK, []))
    assert rows(sketches) == []
    assert rows(trending.trending(sketches, "bucket")) == []


def test_tasks_without_sketches(spark, make):
    """A filter leaves no rows to some tasks, or to all, of a ranking without groups."""
    data = [(1, NOON), (1, NOON), (2, at("2026-01-12T12:00:00"))]
    sketches = trending.item_sketches(make(CLICK, data)).repartitionByRange(2, "bucket")
    assert sketches.rdd.getNumPartitions() == 2
    last = sketches.localCheckpoint().filter(F.col("bucket") >= F.lit("2026-01-12").cast("timestamp"))
    assert rows(trending.trending(last)) == [(2, 1, 1, 1, 0)]
    assert rows(trending.trending(last.filter(F.col("clicks") > 5))) == []


def test_recall_and_error_of_many_items(spark):
    """200,000 clicks on some 30,000 items, of which a sketch tracks 1,000."""
    skewed = spark.range(200_000).select(
        F.floor(F.pow(F.lit(30_000.0), F.rand(7))).cast("long").alias("item_id"),
        F.timestamp_seconds(1_768_132_800 + F.col("id") % 86_400).alias("event_ts"),
    )
    exact = {r[0]: r[1] for r in skewed.groupBy("item_id").count().collect()}
    best = sorted(exact, key=lambda item: (-exact[item], item))[:20]
    found = trending.trending(
        trending.item_sketches(skewed, capacity=1000), limit=20, capacity=1000
    ).collect()
    assert len({r.item_id for r in found} & set(best)) >= 0.9 * len(best)
    for r in found:
        assert r.group_clicks == 200_000 and 0 < r.most_error <= 700
        assert exact[r.item_id] <= r.clicks <= exact[r.item_id] + r.most_error


def test_stream_adds_each_batch_once(spark, make, folder):
    for k, item in enumerate([1, 2, 2]):
        make(CLICK, [(item, NOON)] * (k + 1)).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        reader = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1)
        query = jobs.start_trending_sketches(
            reader.parquet(f"{folder}/in"), f"{folder}/t", f"{folder}/c", trigger=jobs.AVAILABLE_NOW
        )
        jobs.run_available({"trending": query})
        return trending.trending(published.read(spark, f"{folder}/t"), "bucket_date")

    assert rows(run(), "item_id", "clicks", "rank") == [(1, 1, 2), (2, 5, 1)]
    make(CLICK, [(1, NOON)] * 9).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert rows(run(), "item_id", "clicks", "rank") == [(1, 10, 1), (2, 5, 2)]
