"""The detection job as one streaming query.

Events are split, deduplicated and handed on once; a micro-batch then feeds all
outputs. The only state that Spark keeps is that of the deduplication. Window
counts are a published table of panes (:mod:`millrace.operators.panes`): a batch
merges its panes into the buckets of time that it touches, and reads the
windows that changed from there, with exact distinct items. Both detectors use
the same panes.

Panes are published together with the number of the batch, so a batch that is
repeated after a crash does not count twice; its anomalies come out again from
the panes that it changed and replace its own files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import detect, ingest, panes
from millrace.sinks import published, tables
from millrace.sinks.anomalies import WINDOW_DATE, batches_path
from millrace.streaming.jobs import DetectionSettings, with_window_date

NAME = "detection"
PANES = "anomaly_panes"
#: Batches between two times that expired buckets and old files are removed.
TIDY_EVERY = 20

Sink = Callable[[DataFrame, int], None]


class Detector:
    """What one micro-batch does; the tables below ``out`` are all its state."""

    def __init__(
        self,
        out: str,
        settings: DetectionSettings,
        sink: Sink | None = None,
        late_kafka: tuple[str, str] | None = None,
    ):
        self.out, self.s, self.late_kafka = out.rstrip("/"), settings, late_kafka
        self.path = f"{self.out}/{PANES}"
        lengths = (settings.high_frequency_window, settings.bot_window, settings.bot_slide)
        self.pane = panes.pane_seconds(*lengths)
        # Windows of a pane reach no further than the buckets beside its own.
        self.bucket = max(panes.seconds(length) for length in lengths)
        self.sink = sink or self._append

    def _append(self, anomalies: DataFrame, batch_id: int) -> None:
        stamped = ingest.stamp(with_window_date(anomalies), "db_write_ts")
        tables.append_version(stamped, batches_path(self.out, NAME), batch_id, WINDOW_DATE)

    def split(self, events: DataFrame) -> DataFrame:
        """All events in one frame by ``route``: unique ones as columns, late ones and
        dead letters as key and value."""
        usable, letters = ingest.unusable(events)
        on_time, late = ingest.split_late(usable, self.s.watermark_minutes, self.s.now)
        unique = ingest.drop_duplicate_events(
            on_time, f"{self.s.watermark_minutes} minutes", spread=self.s.dedup_spread
        ).select("session_id", "item_id", "event_ts", "kafka_ingest_ts")
        parts = {
            "events": unique,
            "late_events": ingest.late_payload(late),
            "dead_letters": letters,
        }
        routed = [df.withColumn("route", F.lit(route)) for route, df in parts.items()]
        first, *rest = routed
        for df in rest:
            first = first.unionByName(df, allowMissingColumns=True)
        return first

    def number(self, folder: str) -> int:
        return int(folder.split("=", 1)[1])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            for route in ("late_events", "dead_letters"):
                side = rows.filter(F.col("route") == route).select("key", "value")
                if route == "late_events" and self.late_kafka:
                    servers, topic = self.late_kafka
                    options = {"kafka.bootstrap.servers": servers, "topic": topic}
                    side.write.format("kafka").options(**options).save()
                else:
                    side.write.mode("overwrite").parquet(f"{self.out}/{route}/batch_id={batch_id}")
            self.detect(rows.filter(F.col("route") == "events"), batch_id)
        finally:
            rows.unpersist()
        if batch_id % TIDY_EVERY == TIDY_EVERY - 1:
            self.tidy()

    def detect(self, events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        new = panes.digest(events, self.pane)
        bucket = F.floor(F.unix_seconds("pane_start") / self.bucket)
        # As many rows as there are buckets within the watermark's delay.
        touched = {r[0] for r in new.select(bucket).distinct().collect()}
        if not touched:
            return
        schema = T.StructType(
            [*new.schema.fields, T.StructField("changed_in", T.LongType()), T.StructField("bucket", T.LongType())]
        )
        base = published.version(spark, self.path)
        if not base.done(NAME, batch_id):
            stored = published.read(
                spark, self.path, schema, lambda f: self.number(f) in touched, base.number
            ).drop("bucket")
            merged = panes.merge(stored, new, batch_id).withColumn("bucket", bucket)
            published.replace(merged, self.path, "bucket", base=base, writer=NAME, batch=batch_id)
        near = {b + step for b in touched for step in (-1, 0, 1)}
        live = published.read(spark, self.path, schema, lambda f: self.number(f) in near)
        # Without panes from before there is no anomaly to take back.
        self.sink(self.anomalies(live, batch_id, retract=base.number > 0), batch_id)

    def anomalies(self, live: DataFrame, batch_id: int, retract: bool = True) -> DataFrame:
        """Anomalies of the windows that this batch changed, and with ``retract`` rows
        without a score for windows that may have been anomalies before."""
        s = self.s
        changed = F.col("changed_in") == batch_id
        return detect.high_frequency(
            panes.windows(live, s.high_frequency_window).filter(changed), s.high_frequency_clicks
        ).unionByName(
            detect.bot_like(
                panes.windows(live, s.bot_window, s.bot_slide).filter(changed),
                s.bot_clicks,
                s.bot_diversity,
                retract=retract,
            )
        )

    def tidy(self) -> None:
        """Remove buckets behind the watermark and files that no version needs."""
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        folders = published.version(spark, self.path).folders
        if folders:
            newest = max(map(self.number, folders))
            # A window of a live pane may begin one bucket earlier.
            reach = -(-self.s.watermark_minutes * 60 // self.bucket) + 2
            published.drop(spark, self.path, lambda f: self.number(f) < newest - reach)
        published.vacuum(spark, self.path, older_than=dt.timedelta(minutes=10))


def start_detection_query(
    events: DataFrame,
    out: str,
    checkpoint: str,
    settings: DetectionSettings | None = None,
    sink: Sink | None = None,
    late_kafka: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Start the job: late events, dead letters, panes and anomalies below ``out``.

    ``late_kafka`` (servers, topic) takes the late events instead of files; a
    batch that is repeated sends them again, with the same keys.
    ``sink`` replaces the anomaly batches, which ``read_anomaly_table`` reads; it
    gets a window again whenever the window changes, so it has to replace by key;
    a row without a score takes the anomaly of its key back.
    """
    s = settings or DetectionSettings()
    detector = Detector(out, s, sink, late_kafka)
    return (
        detector.split(events)
        .writeStream.queryName(NAME)
        .outputMode("append")
        .foreachBatch(detector)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{NAME}")
        .trigger(**s.trigger)
        .start()
    )
