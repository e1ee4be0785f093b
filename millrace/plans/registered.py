"""Named queries over the bundled tables, each as ``(spark, sf_dir) -> DataFrame``.

Parameters are scaled to the tables (events are minutes apart), the operators
are the production ones. Results carry plain types: times without a zone,
money as double, collections as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas as S
from millrace.functions import ids, times
from millrace.functions.joins import null_safe_join
from millrace.functions.values import computed_once, normal_category
from millrace.operators import (
    daily,
    detect,
    funnel,
    ingest,
    items,
    ops,
    partials,
    progress,
    quality,
    sessions,
    slo,
    trending,
)
from millrace.plans import daily_jobs, incremental, serving, sql_functions
from millrace.session import (
    BASE_CONF,
    session_conf,
    state_conf,
    work_path,
)
from millrace.sinks import lake as lake_sink
from millrace.sinks import published, tables
from millrace.sinks.anomalies import (
    ANOMALY_KEYS,
    WINDOW_DATE,
    batches_path,
    compact_anomalies,
    read_anomaly_table,
)
from millrace.sources import csv_files, lake
from millrace.sources import event_table as et
from millrace.sources import tables as result_tables
from millrace.sources.progress_log import parse_progress_lines, progress_rows
from millrace.streaming import detection, jobs, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-31"
DAY = "2024-01-15"
LATE_MINUTES = 5 * 24 * 60


def plain(df: DataFrame) -> DataFrame:
    """Types both engines share."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = times.wall_time(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    """Register under the function's name, in UTC and with plain result types."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", BASE_CONF["spark.sql.session.timeZone"])
        return plain(fn(spark, sf_dir.rstrip("/")))

    QUERIES[fn.__name__] = run
    return fn


# --- shared inputs --------------------------------------------------------------


def _detection(spark: SparkSession, d: str) -> DataFrame:
    return et.detection_events(et.read_events(spark, d))


def _high_frequency(spark: SparkSession, d: str) -> DataFrame:
    return detect.detect_high_frequency(_detection(spark, d), "1 day", 3)


def _bot_like(spark: SparkSession, d: str) -> DataFrame:
    return detect.detect_bot_like(_detection(spark, d), "2 days", "1 day", 5, 0.6)


def _anomalies(spark: SparkSession, d: str) -> DataFrame:
    return _high_frequency(spark, d).unionByName(_bot_like(spark, d))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return daily.daily_metrics(et.read_activity(spark, d))


def _items(spark: SparkSession, d: str) -> DataFrame:
    return items.popular_items(et.read_activity(spark, d))


def _categories(spark: SparkSession, d: str) -> DataFrame:
    return items.top_categories(items.activity_category_stats(et.read_activity(spark, d)))


def _funnel(spark: SparkSession, d: str) -> DataFrame:
    return funnel.session_funnel(et.read_activity(spark, d))


def _last_event(spark: SparkSession, d: str) -> Column:
    return et.read_events(spark, d).select(F.max("event_ts")).scalar()


def _stable(anomalies: DataFrame) -> DataFrame:
    """Without the wall clock."""
    return anomalies.drop("spark_process_ts")


# --- daily reports --------------------------------------------------------------


@query
def daily_metrics(spark, d):
    return _daily(spark, d)


@query
def click_totals(spark, d):
    return daily.click_totals(et.read_clicks(spark, d))


@query
def purchase_totals(spark, d):
    return daily.purchase_totals(et.read_purchases(spark, d))


@query
def session_stats(spark, d):
    return daily.click_sessions(et.read_clicks(spark, d))


@query
def session_averages(spark, d):
    return daily.session_averages(et.read_clicks(spark, d))


@query
def file_totals(spark, d):
    return daily.file_totals(et.read_purchases(spark, d))


@query
def clicks_per_item(spark, d):
    return items.clicks_per_item(et.read_clicks(spark, d))


@query
def purchases_per_item(spark, d):
    return items.purchases_per_item(et.read_purchases(spark, d))


@query
def item_primary_category(spark, d):
    return items.primary_category(et.read_clicks(spark, d), by=["item_id"])


@query
def popular_items(spark, d):
    return _items(spark, d)


@query
def category_clicks(spark, d):
    return items.category_clicks(et.read_clicks(spark, d))


@query
def category_purchases(spark, d):
    return items.category_purchases(et.read_clicks(spark, d), et.read_purchases(spark, d))


@query
def popular_categories(spark, d):
    return _categories(spark, d)


@query
def popular_categories_primary(spark, d):
    return items.popular_categories(
        et.read_clicks(spark, d), et.read_purchases(spark, d), attribution="primary"
    )


@query
def funnel_sessions(spark, d):
    return funnel.funnel_sessions(et.read_activity(spark, d))


@query
def session_funnel(spark, d):
    return _funnel(spark, d)


@query
def session_summary(spark, d):
    per_session = et.read_events(spark, d).select(
        F.col("session_id"),
        F.col("item_id"),
        "event_ts",
        F.col("event_ts").alias("kafka_ingest_ts"),
    )
    odd = detect.detect_high_frequency(per_session, "1 day", 3)
    return sessions.session_summary(et.read_activity(spark, d), odd)


def _load(events: DataFrame, root: str, batch: str) -> None:
    """Clicks and purchases of events with a category to a lake."""
    clicked = events.filter(F.col("event_type").isin("click", "view"))
    lake_sink.write_lake(_lake_clicks(clicked), root, "click", batch)
    lake_sink.write_lake(_lake_purchases(et.purchases_of(events)), root, "purchase", batch)


@query
def session_days(spark, d):
    """Sessions over midnight, from two runs, the later days first."""
    out = work_path(spark, "session_days")
    # All events of a user; a day without any ends a session.
    events = et.with_category(et.read_events(spark, d)).withColumn("session_id", F.col("user_id"))
    _load(events, f"{out}/lake", "all")
    for start, end in (("2024-01-16", "2024-02-10"), ("2024-01-01", "2024-01-15")):
        daily_jobs.run_sessions(spark, f"{out}/lake", f"{out}/tables", start, end)
    return result_tables.read_table(spark, f"{out}/tables", "session_summary").drop("is_anomaly")


# --- daily reports by changed hours -----------------------------------------------


def _refreshed(spark: SparkSession, d: str) -> str:
    """Tables of a lake that is loaded and refreshed, then gets a wrong half day, a
    refresh, the right half day in its place and a refresh.

    The events of half a day move into its first hour: days stay as they are.
    """
    out = work_path(spark, "incremental")
    hours = F.make_dt_interval(hours=F.hour("event_ts") % 12)
    events = et.with_category(et.read_events(spark, d))
    events = events.withColumn("event_ts", F.col("event_ts") - hours)
    events = events.withColumn("event_ms", F.unix_millis("event_ts"))
    half_day = times.on_day(F.col("event_ts"), DAY) & (F.hour("event_ts") < 12)
    wrong = events.withColumn("price", F.lit(1).cast("decimal(12,2)")).filter(F.col("eid") % 3 > 0)
    for batch, rows in (
        ("rest", events.filter(~half_day)),
        ("late", wrong.filter(half_day)),
        ("late", events.filter(half_day)),
    ):
        _load(rows, f"{out}/lake", batch)
        incremental.refresh_daily(spark, f"{out}/lake", f"{out}/tables", "2024-01-01", "2024-12-31")
    return f"{out}/tables"


@query
def incremental_daily(spark, d):
    return result_tables.read_table(spark, _refreshed(spark, d), "daily_metrics").drop(
        "created_at", "updated_at", "avg_session_duration_sec"
    )


@query
def incremental_items(spark, d):
    return result_tables.read_table(spark, _refreshed(spark, d), "popular_items").drop("created_at")


@query
def range_distinct(spark, d):
    """Distinct sessions and items of each week, and of all time, from hourly sketches:
    exact counts beside whether the estimates are within their bound."""
    sums = partials.partials(et.read_activity(spark, d))
    hours = partials.hour_sketches(sums).withColumn("week", F.date_trunc("week", "metric_date"))
    estimates = partials.over_range(hours, "week").unionByName(
        partials.over_range(hours).withColumn("week", F.lit(None).cast("timestamp"))
    )
    clicks = et.read_clicks(spark, d).withColumn("week", F.date_trunc("week", "metric_date"))
    exact = clicks.groupingSets([[F.col("week")], []], F.col("week")).agg(
        F.count("*").alias("clicks"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("item_id").alias("items"),
    )

    def near(estimate: str, count: str) -> Column:
        bound = F.col(count) * partials.SKETCH_ERROR
        return F.abs(F.col(estimate) - F.col(count)) <= bound

    return null_safe_join(exact, estimates, ["week"], "inner").select(
        F.to_date("week").alias("week"),
        "clicks",
        "sessions",
        "items",
        "total_purchases",
        "total_revenue",
        near("unique_sessions", "sessions").alias("sessions_near"),
        near("unique_items", "items").alias("items_near"),
    )


# --- detection ------------------------------------------------------------------


@query
def detect_high_frequency(spark, d):
    return _stable(_high_frequency(spark, d))


@query
def detect_bot_like(spark, d):
    return _stable(_bot_like(spark, d))


def _stream_detection(spark: SparkSession, d: str) -> DataFrame:
    return et.detection_events(et.as_events(et.stream_raw(spark, d)))


STREAM_SETTINGS = jobs.DetectionSettings(
    watermark_minutes=LATE_MINUTES,
    high_frequency_window="1 day",
    high_frequency_clicks=3,
    bot_window="2 days",
    bot_slide="1 day",
    bot_clicks=5,
    bot_diversity=0.6,
    trigger=jobs.AVAILABLE_NOW,
    late_trigger=jobs.AVAILABLE_NOW,
)


# Partitions of every stateful query here; a stream keeps what it first had.
STREAM_PARTITIONS = "8"


def _stream_conf(spark: SparkSession) -> dict[str, str]:
    return state_conf() | {"spark.sql.shuffle.partitions": STREAM_PARTITIONS}


def _run_stream_detection(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Duplicates in, watermark, dedup, windows, versioned sink, current rows out."""
    s = STREAM_SETTINGS
    source = _stream_detection(spark, d)
    unique = ingest.drop_duplicate_events(
        source.unionByName(source), f"{s.watermark_minutes} minutes"
    )
    found = {
        "high_frequency": lambda: detect.detect_high_frequency(
            unique, s.high_frequency_window, s.high_frequency_clicks
        ),
        "bot_like": lambda: detect.detect_bot_like(
            unique, s.bot_window, s.bot_slide, s.bot_clicks, s.bot_diversity
        ),
    }[name]()
    out = work_path(spark, f"stream_{name}")
    with session_conf(spark, _stream_conf(spark)):
        started = jobs.start_anomalies(
            found, name, batches_path(out, name), f"{out}/checkpoint", s.trigger
        )
        jobs.run_available({name: started})
    current = read_anomaly_table(spark, out)
    return _stable(current).drop(WINDOW_DATE, "db_write_ts")


@query
def stream_high_frequency(spark, d):
    return _run_stream_detection(spark, d, "high_frequency")


@query
def stream_bot_like(spark, d):
    return _run_stream_detection(spark, d, "bot_like")


@query
def stream_anomaly_table(spark, d):
    """Both detectors into one table, compacted between them, served newest first."""
    out = work_path(spark, "stream_anomalies")
    # The clock stands at the first day, so that no event is late.
    s = replace(STREAM_SETTINGS, now="2024-01-01")
    events = _stream_detection(spark, d).withColumn("event_type", F.col("item_id"))

    def sink(anomalies: DataFrame, batch_id: int) -> None:
        stamped = ingest.stamp(jobs.with_window_date(anomalies), "db_write_ts")
        for name in ("high_frequency", "bot_like"):
            one = stamped.filter(F.col("anomaly_type") == name.upper())
            tables.append_version(one, batches_path(out, name), batch_id, WINDOW_DATE)
            if name == "high_frequency":
                compact_anomalies(spark, out)

    # Events are deduplicated once; windows come from panes, not from a state store.
    with session_conf(spark, _stream_conf(spark)):
        detection.start_detection_query(events, out, f"{out}/checkpoint", s, sink).awaitTermination()
    table = _stable(result_tables.read_table(spark, out, "anomaly_sessions"))
    return serving.recent_anomalies(table, 100, "BOT_LIKE", 0.5)


@query
def stream_detection_job(spark, d):
    """The whole job as one query: three micro-batches, every event twice."""
    out = work_path(spark, "detection_job")
    et.read_raw(spark, d).repartitionByRange(3, "ts").write.parquet(f"{out}/events")
    raw = spark.readStream.schema(et.RAW_COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{out}/events")
    events = et.detection_events(et.as_events(raw)).withColumn("event_type", F.col("item_id"))
    # Files may come in any order, and no event is late.
    s = replace(STREAM_SETTINGS, now="2024-01-01", watermark_minutes=60 * 24 * 60)
    with session_conf(spark, _stream_conf(spark)):
        detection.start_detection_query(
            events.unionByName(events), out, f"{out}/checkpoint", s
        ).awaitTermination()
    return _stable(read_anomaly_table(spark, out)).drop(WINDOW_DATE, "db_write_ts")


@query
def routed_events(spark, d):
    """Rows by where the job sends them; together they are all rows."""
    events = _late_input(et.read_events(spark, d))
    damaged = events.withColumns(
        {
            "session_id": F.when(F.col("event_id") % 40 != 0, F.col("session_id")),
            "event_ts": F.when(F.col("event_id") % 30 != 0, F.col("event_ts")),
        }
    )
    usable, letters = ingest.unusable(damaged)
    on_time, late = ingest.split_late(usable, LATE_MINUTES, _last_event(spark, d))
    reason = F.get_json_object("value", "$.reason")
    parts = [
        on_time.select(F.lit("on_time").alias("route")),
        late.select(F.lit("late").alias("route")),
        letters.select(reason.alias("route")),
    ]
    return (
        parts[0].union(parts[1]).union(parts[2]).groupBy("route").agg(F.count("*").alias("rows"))
    )


@query
def stream_dedup(spark, d):
    source = _stream_detection(spark, d)
    unique = ingest.drop_duplicate_events(
        source.unionByName(source), f"{LATE_MINUTES} minutes"
    )
    out = work_path(spark, "stream_dedup")
    with session_conf(spark, _stream_conf(spark)):
        started = (
            unique.writeStream.queryName("dedup")
            .outputMode("append")
            .format("parquet")
            .option("path", f"{out}/rows")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(**jobs.AVAILABLE_NOW)
            .start()
        )
        jobs.run_available({"dedup": started})
    return spark.read.schema(unique.schema).parquet(f"{out}/rows")


def _stream_file(spark: SparkSession, path: str) -> DataFrame:
    """Detection events of a folder of raw events, a file in each micro-batch."""
    reader = spark.readStream.schema(et.RAW_COLUMNS).option("maxFilesPerTrigger", 1)
    return et.detection_events(et.as_events(reader.parquet(path)))


@query
def stream_resume(spark, d):
    """Dedup under a processing-time trigger, stopped and resumed from its checkpoint;
    all events of the first run come again in the second."""
    out = work_path(spark, "stream_resume")
    raw = et.read_raw(spark, d)
    with session_conf(spark, _stream_conf(spark)):
        for batch in (raw.filter("event_id % 2 = 0"), raw):
            batch.coalesce(2).write.mode("append").parquet(f"{out}/events")
            events = _stream_file(spark, f"{out}/events")
            unique = ingest.drop_duplicate_events(events, f"{60 * 24 * 60} minutes")
            running = (
                unique.writeStream.queryName("resume")
                .outputMode("append")
                .format("parquet")
                .option("path", f"{out}/rows")
                .option("checkpointLocation", f"{out}/checkpoint")
                .trigger(processingTime="1 second")
                .start()
            )
            try:
                running.processAllAvailable()
            finally:
                running.stop()
    return spark.read.schema(unique.schema).parquet(f"{out}/rows")


@query
def stream_state(spark, d):
    """Keys the dedup state holds after the last event: those within the watermark."""
    out = work_path(spark, "stream_state")
    raw = et.read_raw(spark, d)
    halves = [raw.filter(F.col("ts") < F.lit(DAY)), raw.filter(F.col("ts") >= F.lit(DAY))]
    with session_conf(spark, _stream_conf(spark)):
        for half in halves:
            half.coalesce(1).write.mode("append").parquet(f"{out}/events")
            events = _stream_file(spark, f"{out}/events")
            unique = ingest.drop_duplicate_events(events, "1 day")
            started = (
                unique.writeStream.queryName("state")
                .outputMode("append")
                .format("noop")
                .option("checkpointLocation", f"{out}/checkpoint")
                .trigger(**jobs.AVAILABLE_NOW)
                .start()
            )
            jobs.run_available({"state": started})
    return state.state_sizes(spark, f"{out}/checkpoint").select(
        "operator_id", "operator_name", "partitions", "keys", (F.col("bytes") > 0).alias("has_bytes")
    )


@query
def stream_append(spark, d):
    """Events appended batch by batch, each batch delivered twice."""
    out = work_path(spark, "stream_append")
    et.read_raw(spark, d).repartition(3, "event_id").write.parquet(f"{out}/events")
    events = _stream_file(spark, f"{out}/events").withColumn("event_date", F.to_date("event_ts"))
    append = published.append_once(f"{out}/table", "event_date", "stream_append")

    def twice(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        append(batch, batch_id)

    started = (
        events.writeStream.foreachBatch(twice)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**jobs.AVAILABLE_NOW)
        .start()
    )
    jobs.run_available({"append": started})
    return published.read(spark, f"{out}/table").drop("event_date")


@query
def stream_late_events(spark, d):
    """The late side output of the running job, with the data's last time as the clock."""
    events = _late_input(et.as_events(et.stream_raw(spark, d)))
    _, late = ingest.split_late(events, LATE_MINUTES, _last_event(spark, d))
    out = work_path(spark, "stream_late")
    with session_conf(spark, _stream_conf(spark)):
        started = jobs.write_late_events(
            ingest.late_payload(late),
            f"{out}/checkpoint",
            f"{out}/late",
            trigger=jobs.AVAILABLE_NOW,
        )
        jobs.run_available({"late": started})
    return spark.read.schema("key string, value string").parquet(f"{out}/late")


@query
def stream_lake(spark, d):
    """Events to the hourly lake as a stream, read back from the folders."""
    clicks = et.clicks_of(et.as_events(et.stream_raw(spark, d)))
    out = work_path(spark, "stream_lake")
    with session_conf(spark, _stream_conf(spark)):
        started = lake_sink.stream_to_lake(
            _lake_clicks(clicks), f"{out}/lake", "click", f"{out}/checkpoint", jobs.AVAILABLE_NOW
        )
        jobs.run_available({"lake": started})
    return lake.read_events(spark, f"{out}/lake", "click").drop("ingest_ts")


# --- ingest ---------------------------------------------------------------------


def _late_input(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("eid").cast("string").alias("event_id"),
        "session_id",
        "item_id",
        "event_type",
        "event_ts",
        F.col("event_ts").alias("kafka_ingest_ts"),
    )


@query
def late_events(spark, d):
    events = _late_input(et.read_events(spark, d))
    return ingest.split_late(events, LATE_MINUTES, _last_event(spark, d))[1]


@query
def on_time_events(spark, d):
    events = _late_input(et.read_events(spark, d))
    return ingest.split_late(events, LATE_MINUTES, _last_event(spark, d))[0]


@query
def late_payload(spark, d):
    events = _late_input(et.read_events(spark, d))
    late = ingest.split_late(events, LATE_MINUTES, _last_event(spark, d))[1]
    return ingest.late_payload(late)


@query
def repaired_events(spark, d):
    """Long event times, missing ingest times and blank ids put right."""
    events = et.read_events(spark, d)
    remainder = F.col("eid") % 3
    damaged = events.select(
        "eid",
        "session_id",
        F.col("event_ms").alias("event_ts"),
        "item_id",
        "event_type",
        F.when(remainder == 0, F.lit(" ")).when(
            remainder == 1, F.col("eid").cast("string")
        ).alias("event_id"),
        F.when(remainder == 0, F.lit(0).cast("long"))
        .when(remainder == 1, F.col("event_ms") + 5)
        .alias("ingest_ts"),
        (F.col("event_ts") + F.expr("interval 2 seconds")).alias("kafka_ingest_ts"),
    )
    return ingest.repair(damaged)


@query
def event_ids(spark, d):
    clicks = et.read_clicks(spark, d)
    made = ids.click_event_id(
        F.col("session_id"), F.col("item_id"), F.col("event_ms"), F.lit("click")
    )
    return clicks.select("eid", made.alias("event_id"))


@query
def purchase_event_ids(spark, d):
    purchases = et.read_purchases(spark, d)
    made = ids.purchase_event_id(
        F.col("session_id"),
        F.col("item_id"),
        F.col("event_ms"),
        F.col("quantity"),
        F.col("price"),
    )
    return purchases.select("eid", made.alias("event_id"))


def _raw_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Text rows as a CSV file would hold them, some of them damaged."""
    events = et.with_category(et.read_events(spark, d))
    iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return computed_once(
        events,
        F.col("session_id").cast("string").alias("Session ID"),
        F.when(F.col("eid") % 75 == 0, "")
        .when(F.col("eid") % 61 == 0, F.date_format("event_ts", "HH:mm:ss"))
        .when(F.col("eid") % 67 == 0, F.date_format("event_ts", "yyyy"))
        .when(F.col("eid") % 71 == 0, F.concat(F.lit("-"), iso))
        .otherwise(iso)
        .alias("Timestamp"),
        F.when(F.col("eid") % 50 == 0, "x")
        .otherwise(F.col("item_id").cast("string"))
        .alias("Item ID"),
        F.coalesce("category", F.lit("0")).alias("Category"),
    )


@query
def valid_events(spark, d):
    parsed = ingest.parse_clicks(_raw_clicks(spark, d))
    return ingest.split_valid(parsed)[0].drop("ingest_ts")


@query
def dead_letters(spark, d):
    rejects = ingest.split_valid(ingest.parse_clicks(_raw_clicks(spark, d)))[1]
    return ingest.dead_letters(rejects, "click-loader", "clicks", now=_last_event(spark, d))


@query
def csv_clicks(spark, d):
    """The damaged rows through files with a header; the sources are looked at first."""
    path = f"{work_path(spark, 'csv')}/clicks"
    _raw_clicks(spark, d).write.option("header", True).csv(path)
    return ingest.split_valid(csv_files.read_click_csv(spark, path))[0].drop("ingest_ts")


@query
def csv_purchases(spark, d):
    path = f"{work_path(spark, 'csv')}/purchases"
    _raw_purchases(spark, d).write.option("header", True).csv(path)
    return ingest.split_valid(csv_files.read_purchase_csv(spark, path))[0].drop("ingest_ts")


def _raw_purchases(spark: SparkSession, d: str) -> DataFrame:
    events = et.read_purchases(spark, d)
    return computed_once(
        events,
        F.col("session_id").cast("string").alias("Session ID"),
        F.when(F.col("eid") % 17 == 0, F.date_format("event_ts", "'T'HH:mm"))
        .otherwise(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .alias("Timestamp"),
        F.col("item_id").cast("string").alias("Item ID"),
        F.when(F.col("eid") % 20 == 0, "n/a")
        .otherwise(F.col("price").cast("string"))
        .alias("Price"),
        F.when(F.col("eid") % 30 == 0, "1.5")
        .otherwise(F.col("quantity").cast("string"))
        .alias("Quantity"),
    )


@query
def valid_purchases(spark, d):
    parsed = ingest.parse_purchases(_raw_purchases(spark, d))
    return ingest.split_valid(parsed)[0].drop("ingest_ts")


@query
def rejected_purchases(spark, d):
    rejects = ingest.split_valid(ingest.parse_purchases(_raw_purchases(spark, d)))[1]
    return rejects.groupBy("error").agg(F.count("*").alias("rows"))


@query
def category_normalised(spark, d):
    events = et.with_category(et.read_events(spark, d))
    raw = F.when(F.col("eid") % 4 == 0, F.lit("")).otherwise(F.coalesce("category", F.lit("0")))
    return events.select("eid", normal_category(raw).alias("category"))


@query
def one_day(spark, d):
    return ingest.select_day(et.read_events(spark, d), DAY).select(
        "eid", "event_ts", "session_id", "item_id", "event_type"
    )


@query
def rebased_events(spark, d):
    return ingest.rebase_date(et.read_events(spark, d), "2030-06-01").select("eid", "event_ts")


@query
def shifted_events(spark, d):
    return ingest.shift_to(et.read_events(spark, d), "2030-06-01 10:00:00").select(
        "eid", "event_ts"
    )


@query
def sorted_events(spark, d):
    return lake_sink.sorted_by_time(
        et.read_events(spark, d).select("event_ts", "eid", "session_id"), "event_ts", "eid"
    )


# --- sinks ----------------------------------------------------------------------


def _lake_clicks(clicks: DataFrame) -> DataFrame:
    made = ids.click_event_id(
        F.col("session_id"), F.col("item_id"), F.col("event_ms"), F.lit("click")
    )
    return clicks.select(
        "session_id",
        "event_ts",
        "item_id",
        "category",
        F.lit("click").alias("event_type"),
        made.alias("event_id"),
        F.col("event_ts").alias("ingest_ts"),
        F.lit("lake").alias("source"),
    )


def _lake_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.select(
        "session_id",
        "event_ts",
        "item_id",
        "price",
        "quantity",
        F.lit("purchase").alias("event_type"),
        F.col("eid").cast("string").alias("event_id"),
        F.col("event_ts").alias("ingest_ts"),
        F.lit("lake").alias("source"),
    )


@query
def lake_roundtrip(spark, d):
    root = work_path(spark, "lake")
    clicks = _lake_clicks(et.read_clicks(spark, d))
    # Two loads, one of them repeated; the day and the rest come back as one lake.
    day = times.on_day(F.col("event_ts"), DAY)
    lake_sink.write_lake(clicks.filter(~day), root, "click", "rest")
    for _ in range(2):
        lake_sink.write_lake(clicks.filter(day), root, "click", "day")
    return lake.read_events(spark, root, "click").drop("ingest_ts")


@query
def lake_day(spark, d):
    """One day of a lake that a stream and a load wrote into together."""
    clicks = et.clicks_of(et.as_events(et.stream_raw(spark, d)))
    out = work_path(spark, "lake_day")
    with session_conf(spark, _stream_conf(spark)):
        even = _lake_clicks(clicks.filter(F.col("eid") % 2 == 0))
        started = lake_sink.stream_to_lake(
            even, f"{out}/lake", "click", f"{out}/checkpoint", jobs.AVAILABLE_NOW
        )
        jobs.run_available({"lake": started})
    odd = et.read_clicks(spark, d).filter(F.col("eid") % 2 == 1)
    lake_sink.write_lake(_lake_clicks(odd), f"{out}/lake", "click", "odd")
    return lake.read_events(spark, f"{out}/lake", "click", DAY).drop("ingest_ts")


@query
def replace_date_roundtrip(spark, d):
    """All dates, then one date replaced with other figures and one with nothing."""
    path = f"{work_path(spark, 'replace')}/daily_metrics"
    report = _daily(spark, d).select("metric_date", "total_clicks", "total_revenue")
    tables.replace_dates(report, path)
    changed = report.withColumn("total_clicks", F.col("total_clicks") + 1000)
    tables.replace_date(changed, path, DAY)
    # A range that has no rows for one of its days.
    rest = report.filter(F.col("metric_date") != F.lit("2024-01-20").cast("date"))
    tables.replace_dates(rest, path, days=["2024-01-19", "2024-01-20", "2024-01-21"])
    return published.read(spark, path, report.schema)


@query
def upsert_roundtrip(spark, d):
    """High-frequency rows, then changed ones and the bot rows merged in, twice."""
    path = f"{work_path(spark, 'upsert')}/anomaly_sessions"
    keys, by = ANOMALY_KEYS, WINDOW_DATE
    kept = ["session_id", "window_start", "anomaly_type", "click_count", by]
    first = jobs.with_window_date(_high_frequency(spark, d)).select(*kept)
    tables.upsert(first, path, keys, by, batch="0")
    again = first.filter(F.col("click_count") > 4).withColumn(
        "click_count", F.col("click_count") * 10
    )
    changes = again.unionByName(jobs.with_window_date(_bot_like(spark, d)).select(*kept))
    # Rows of no session and no date must be kept, and replaced, like others.
    odd = first.limit(0).schema
    none = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in odd])
    none = none.withColumn("click_count", F.lit(1).cast(odd["click_count"].dataType))
    tables.upsert(none, path, keys, by, batch="none")
    changes = changes.unionByName(none.withColumn("click_count", F.col("click_count") + 1))
    for batch in ("1", "1"):
        tables.upsert(changes, path, keys, by, batch)
    return published.read(spark, path, first.schema)


# --- serving --------------------------------------------------------------------


@query
def recent_anomalies(spark, d):
    return serving.recent_anomalies(_anomalies(spark, d), 100, "BOT_LIKE", 0.5)


@query
def anomaly_types(spark, d):
    return serving.anomaly_types(_anomalies(spark, d))


@query
def anomaly_timeline(spark, d):
    return serving.anomaly_timeline(_anomalies(spark, d), AS_OF, 168)


@query
def anomalies_for_session(spark, d):
    return serving.anomalies_for_session(_anomalies(spark, d), 7)


@query
def daily_range(spark, d):
    return serving.daily_metrics_range(_daily(spark, d), "2024-01-05", "2024-01-25")


@query
def daily_for_date(spark, d):
    return serving.daily_metrics_for(_daily(spark, d), DAY)


@query
def funnel_for_date(spark, d):
    return serving.funnel_for(_funnel(spark, d), DAY)


@query
def summary(spark, d):
    return serving.metrics_summary(_daily(spark, d), AS_OF, 7)


@query
def popular_for_date(spark, d):
    return serving.popular_items_for(_items(spark, d), DAY, 50)


@query
def categories_for_date(spark, d):
    return serving.popular_categories_for(_categories(spark, d), DAY, 20)


@query
def trending_items(spark, d):
    return serving.trending_items(_items(spark, d), AS_OF, 7, 20)


@query
def view_recent_anomalies(spark, d):
    return serving.view_recent_anomalies(_anomalies(spark, d), "2024-01-30 23:00:00")


@query
def view_daily_summary(spark, d):
    return serving.view_daily_summary(_daily(spark, d), AS_OF)


@query
def view_top_items(spark, d):
    return serving.view_top_items(_items(spark, d), AS_OF)


@query
def view_latest_funnel(spark, d):
    return serving.view_latest_funnel(_funnel(spark, d))


def _by_function(spark: SparkSession, call: str, **tables: DataFrame) -> DataFrame:
    sql_functions.register(spark, tables)
    return spark.sql(f"SELECT * FROM {call}")


@query
def sql_recent_anomalies(spark, d):
    call = "recent_anomaly_sessions(TIMESTAMP'2024-01-30 23:00:00')"
    return _by_function(spark, call, anomaly_sessions=_anomalies(spark, d))


@query
def sql_daily_summary(spark, d):
    call = f"daily_summary(DATE'{AS_OF}', days => 30)"
    return _by_function(spark, call, daily_metrics=_daily(spark, d))


@query
def sql_top_items(spark, d):
    return _by_function(spark, f"top_items(DATE'{AS_OF}')", popular_items=_items(spark, d))


@query
def sql_latest_funnel(spark, d):
    return _by_function(spark, "latest_funnel()", session_funnel=_funnel(spark, d))


@query
def system_stats(spark, d):
    return serving.system_stats(_anomalies(spark, d), _daily(spark, d), _items(spark, d))


@query
def system_health(spark, d):
    return serving.system_health(
        _anomalies(spark, d), _daily(spark, d), _items(spark, d), updated="metric_date"
    )


@query
def row_counts_for_date(spark, d):
    return ops.row_counts(
        {
            "daily_metrics": _daily(spark, d),
            "popular_items": _items(spark, d),
            "popular_categories": _categories(spark, d),
            "session_funnel": _funnel(spark, d),
        },
        DAY,
    )


@query
def duplicate_keys(spark, d):
    return ops.duplicate_keys(et.read_clicks(spark, d), ["session_id", "item_id"])


@query
def kpi_anomalies(spark, d):
    return serving.anomaly_tiles(_anomalies(spark, d))


@query
def kpi_daily(spark, d):
    return serving.daily_tiles(_daily(spark, d))


@query
def score_quartiles(spark, d):
    return serving.score_quartiles(_anomalies(spark, d))


# --- operations -----------------------------------------------------------------


def _dlq_growth(spark: SparkSession, d: str) -> DataFrame:
    """Error events as a dead-letter topic of three partitions, seen once a day."""
    from pyspark.sql import Window

    errors = et.read_events(spark, d).filter(F.col("event_type") == "error")
    daily_counts = errors.groupBy(
        "metric_date", (F.col("user_id") % 3).alias("partition")
    ).agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("partition").orderBy("metric_date")
    snapshots = daily_counts.select(
        F.lit("events.dlq").alias("topic"),
        F.col("metric_date").cast("timestamp").alias("snapshot_ts"),
        "partition",
        F.sum("n").over(so_far).alias("end_offset"),
    )
    return ops.dlq_growth(snapshots)


@query
def dlq_growth(spark, d):
    return _dlq_growth(spark, d).withColumn("offsets", ids.offsets_text(F.col("offsets")))


@query
def alert_history(spark, d):
    growth = _dlq_growth(spark, d)
    known = ops.alert_rows(
        growth.filter(F.col("snapshot_ts") < "2024-01-11"), warning=3, critical=60
    )
    fresh = ops.alert_rows(growth, known, warning=3, critical=60)
    return fresh.withColumn("partition_offsets", ids.offsets_text(F.col("partition_offsets")))


@query
def retention(spark, d):
    rows = jobs.with_window_date(_high_frequency(spark, d))
    return ops.kept(rows, jobs.WINDOW_DATE, AS_OF, 10).select(
        "event_id", "session_id", jobs.WINDOW_DATE
    )


@query
def expired_partitions(spark, d):
    rows = jobs.with_window_date(_high_frequency(spark, d))
    return ops.expired_dates(rows, jobs.WINDOW_DATE, AS_OF, 10)


@query
def run_history(spark, d):
    """One batch run per day of events; those of the last days are still running."""
    days = et.read_events(spark, d).groupBy("metric_date").agg(F.count("*").alias("n"))
    runs = days.select(
        F.date_format("metric_date", "yyyyMMdd").alias("run_id"),
        F.col("metric_date").alias("run_date"),
        "n",
    )
    begun = F.col("run_date").cast("timestamp") + F.expr("interval 18 hours")
    started = ops.run_started(runs, "daily", begun)
    finished = started.join(runs.select("run_id", "n"), "run_id").filter(
        F.col("run_date") < "2024-01-28"
    )
    failed = F.dayofmonth("run_date") % 7 == 0
    ended = ops.run_ended(
        finished,
        F.when(failed, "FAILED").otherwise("SUCCESS"),
        F.when(~failed, F.col("n")),
        F.when(failed, "no click data"),
        F.col("start_time") + F.expr("interval 10 minutes"),
    ).drop("n")
    return ops.latest_runs(started.unionByName(ended))


@query
def quality_checks(spark, d):
    parts = [
        quality.quality_checks(
            _anomalies(spark, d), "anomaly_sessions", quality.anomaly_rules(), AS_OF
        ),
        quality.quality_checks(_daily(spark, d), "daily_metrics", quality.daily_rules(), AS_OF),
        quality.quality_checks(_funnel(spark, d), "session_funnel", quality.funnel_rules(), AS_OF),
        quality.quality_checks(_items(spark, d), "popular_items", quality.item_rules(), AS_OF),
    ]
    clicks = et.read_clicks(spark, d)
    raw = et.read_raw(spark, d)
    expected = T.StructType.fromDDL(et.RAW_COLUMNS)
    parts.append(
        quality.quality_checks(
            raw,
            "events",
            [quality.schema_drift(raw, expected), quality.no_duplicates("event_id")],
            AS_OF,
        )
    )
    parts.append(
        quality.quality_checks(
            clicks, "clicks", [quality.null_rate("category", 0.05, "WARNING")], AS_OF
        )
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _stamped(events: DataFrame) -> DataFrame:
    """Events with the times of all stages, as stored anomalies have them."""

    def later(column: Column, modulus: int) -> Column:
        return F.timestamp_micros(
            F.unix_micros(column) + F.col("eid") % modulus * 1000
        )

    return (
        events.withColumn("kafka_ingest_ts", later(F.col("event_ts"), 700))
        .withColumn("spark_process_ts", later(F.col("kafka_ingest_ts"), 1100))
        .withColumn("db_write_ts", later(F.col("spark_process_ts"), 300))
        .select(
            F.col("event_ms").alias("event_ts"),
            F.col("event_ts").alias("detected_at"),
            "kafka_ingest_ts",
            "spark_process_ts",
            "db_write_ts",
        )
    )


@query
def slo_latency(spark, d):
    return slo.slo_latency(_stamped(et.read_events(spark, d)), AS_OF, 24 * 31)


@query
def slo_report(spark, d):
    """The JSON document, its figures read back."""
    stamped = _stamped(et.read_events(spark, d))
    found = slo.slo_report(stamped, AS_OF, 24 * 31)
    figures = slo.slo_latency(stamped, AS_OF, 24 * 31).schema
    layout = T.StructType(
        [T.StructField("window_hours", T.IntegerType()), T.StructField("report", figures)]
    )
    read = found.select(F.from_json("report", layout).alias("r"))
    return read.select("r.window_hours", "r.report.*")


@query
def stream_latency(spark, d):
    """Percentiles from hourly sketches of three micro-batches, against the exact ranks."""
    out = work_path(spark, "stream_latency")
    et.read_raw(spark, d).repartition(3, "event_id").write.parquet(f"{out}/events")
    reader = spark.readStream.schema(et.RAW_COLUMNS).option("maxFilesPerTrigger", 1)
    stamped = _stamped(et.as_events(reader.parquet(f"{out}/events")))
    started = jobs.start_latency_sketches(
        stamped, f"{out}/table", f"{out}/checkpoint", "1 hour", jobs.AVAILABLE_NOW
    )
    jobs.run_available({"latency": started})
    merged = slo.sketched_latency(published.read(spark, f"{out}/table"))
    figures = merged.select(F.struct("*")).scalar()
    exact = slo.stage_latencies(_stamped(et.read_events(spark, d)), "2030-01-01", 24 * 36500)

    def near(stage: str, p: float) -> Column:
        found = figures[f"p{round(p * 100)}_{stage}"]
        below, upto = F.count_if(F.col(stage) < found), F.count_if(F.col(stage) <= found)
        low, high = below / F.count("*") - slo.RANK_ERROR, upto / F.count("*") + slo.RANK_ERROR
        return F.lit(p).between(low, high).alias(f"p{round(p * 100)}_{stage}")

    return exact.agg(
        F.count("*").alias("rows"),
        F.max(figures["samples"]).alias("samples"),
        *[near(stage, p) for stage in slo.STAGES for p in (0.5, 0.95, 0.99)],
    )


def _trending_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Hourly item sketches of the clicks, from three micro-batches."""
    out = work_path(spark, "stream_trending")
    et.read_raw(spark, d).repartition(3, "event_id").write.parquet(f"{out}/events")
    reader = spark.readStream.schema(et.RAW_COLUMNS).option("maxFilesPerTrigger", 1)
    clicks = et.clicks_of(et.as_events(reader.parquet(f"{out}/events")))
    started = jobs.start_trending_sketches(
        clicks, f"{out}/table", f"{out}/checkpoint", trigger=jobs.AVAILABLE_NOW
    )
    jobs.run_available({"trending": started})
    return published.read(spark, f"{out}/table")


@query
def stream_trending(spark, d):
    """The ten most clicked items of each day, from merged hourly sketches."""
    return trending.trending(_trending_sketches(spark, d), "bucket_date", limit=10)


@query
def stream_trending_range(spark, d):
    """The twenty most clicked items of the last week, by the same sketches."""
    hours = _trending_sketches(spark, d).filter("bucket >= timestamp'2024-01-24'")
    return trending.trending(hours)


def _progress(spark: SparkSession, d: str) -> DataFrame:
    """Events as the progress log of five queries: a micro-batch per type and day.

    The log is made as text lines and read back the way a real one is.
    """
    from pyspark.sql import Window

    part = F.col("user_id") % 3
    n = [F.count_if(part == p).alias(f"n{p}") for p in range(3)]
    batches = et.read_events(spark, d).groupBy("event_type", "metric_date").agg(
        F.count("*").alias("n"), *n
    )
    so_far = Window.partitionBy("event_type").orderBy("metric_date")
    ends = batches.withColumns(
        {f"e{p}": F.sum(f"n{p}").over(so_far) for p in range(3)}
        | {"total": F.sum("n").over(so_far), "batch": F.dayofyear("metric_date") - 1}
    )
    # One query skips an offset every seventh batch.
    gap = F.when((F.col("event_type") == "view") & (F.col("batch") % 7 == 6), 1).otherwise(0)
    trigger = F.col("n") * F.col("n") * 13 % 9000

    def offsets(values: list[Column]) -> Column:
        pairs = [x for p, v in enumerate(values) for x in (F.lit(str(p)), v)]
        return F.create_map(F.lit("clicks"), F.create_map(*pairs))

    source = F.struct(
        offsets([F.col(f"e{p}") - F.col(f"n{p}") + gap for p in range(3)]).alias("startOffset"),
        offsets([F.col(f"e{p}") for p in range(3)]).alias("endOffset"),
        F.create_map(
            F.lit("maxOffsetsBehindLatest"), (F.col("n") * 7 % 5).cast("string")
        ).alias("metrics"),
    )
    lines = ends.select(
        F.to_json(
            F.struct(
                F.lit("query_progress").alias("event"),
                F.col("event_type").alias("name"),
                F.concat(F.lit("run-"), F.col("event_type")).alias("runId"),
                F.col("batch").alias("batchId"),
                F.concat(F.col("metric_date").cast("string"), F.lit("T12:00:00.000Z")).alias(
                    "timestamp"
                ),
                (F.col("n") + F.col("n") % 4).alias("numInputRows"),
                (F.col("n") * 1000 / (trigger + 1)).alias("processedRowsPerSecond"),
                F.struct(trigger.alias("triggerExecution")).alias("durationMs"),
                F.array(source).alias("sources"),
                F.array(F.struct(F.col("total").alias("numRowsTotal"))).alias("stateOperators"),
            )
        ).alias("value")
    )
    return progress_rows(parse_progress_lines(lines), "clicks")


@query
def progress_summary(spark, d):
    return progress.progress_summary(_progress(spark, d))


@query
def offset_continuity(spark, d):
    return progress.offset_continuity(_progress(spark, d))


def _with_target(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the offsets of their query's batch 20 as the target."""
    rows = _progress(spark, d)
    target = (
        rows.filter(F.col("batch_id") <= 20)
        .groupBy("name")
        .agg(F.max_by("end_offsets", "batch_id").alias("target"))
    )
    return rows.join(target, "name")


@query
def query_recovery(spark, d):
    target = F.map_from_entries("target")
    return progress.query_recovery(_with_target(spark, d), "2024-01-15 06:00:00", target)


@query
def recovery_time(spark, d):
    target = F.map_from_entries("target")
    return progress.recovery_time(_with_target(spark, d), "2024-01-15 06:00:00", target)


@query
def capacity_checks(spark, d):
    return progress.capacity_checks(
        progress.progress_summary(_progress(spark, d)),
        ["click", "error", "purchase", "signup", "view", "absent"],
        stateless=["view"],
    )
