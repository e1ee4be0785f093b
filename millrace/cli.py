"""Command line: the batch, the detection job, the latency report, sorting.

    python -m millrace daily 2026-01-11 --lake ROOT --tables ROOT [--only NAME] [--top-n N]
    python -m millrace detect --kafka-servers HOST:PORT --out ROOT --checkpoint ROOT
    python -m millrace slo --tables ROOT [--hours 24]
    python -m millrace load clicks.csv click SOURCE_DATE TARGET_DATE --lake ROOT
    python -m millrace compact --tables ROOT
    python -m millrace ingest FOLDER click --lake ROOT --checkpoint ROOT [--once]
    python -m millrace sessions 2026-01-11 --lake ROOT --tables ROOT
    python -m millrace expire daily_metrics --tables ROOT [--days 30]
    python -m millrace sort clicks.csv sorted/
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
from pathlib import PurePosixPath
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace import schemas
from millrace.functions.times import parse_date
from millrace.operators import ingest, slo
from millrace.plans import daily_jobs
from millrace.session import build_session
from millrace.sinks import lake as lake_sink
from millrace.sinks.anomalies import compact_anomalies, read_anomaly_table
from millrace.sinks.tables import drop_expired_partitions
from millrace.sources import csv_files, kafka
from millrace.streaming import detection, jobs
from millrace.streaming.listener import ProgressListener


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)

    daily = commands.add_parser("daily", help="compute and replace the tables of some days")
    daily.add_argument("start", type=parse_date)
    daily.add_argument("end", type=parse_date, nargs="?")
    daily.add_argument("--lake", required=True)
    daily.add_argument("--tables", required=True)
    daily.add_argument("--only", action="append", help="table to write; may be repeated")
    daily.add_argument("--top-n", type=int, default=100)
    daily.add_argument("--top-categories", type=int, default=20)

    found = commands.add_parser("detect", help="run the anomaly queries on a topic")
    found.add_argument("--kafka-servers", required=True)
    found.add_argument("--click-topic", default="clicks")
    found.add_argument("--late-topic", help="Kafka topic for late events; files otherwise")
    found.add_argument("--schema", help="Avro schema file of the topic")
    found.add_argument("--out", required=True)
    found.add_argument("--checkpoint", required=True)
    found.add_argument("--max-offsets-per-trigger", type=int, default=250_000)
    found.add_argument("--event-time-policy-minutes", type=int, default=10)
    found.add_argument("--dedup-spread", type=int, default=0)
    found.add_argument("--progress-output")
    found.add_argument("--console", action="store_true", help="also print rows for debugging")

    report = commands.add_parser("slo", help="latency report as JSON")
    report.add_argument("--tables", required=True, help="--out of the detection job")
    report.add_argument("--hours", type=int, default=24)
    report.add_argument("--as-of")

    load = commands.add_parser("load", help="one day of a CSV file into the lake")
    load.add_argument("csv")
    load.add_argument("kind", choices=["click", "purchase"])
    load.add_argument("source_date", type=parse_date)
    load.add_argument("target_date", type=parse_date)
    load.add_argument("--lake", required=True)

    fold = commands.add_parser("compact", help="fold the batches of the anomaly table")
    fold.add_argument("--tables", required=True, help="--out of the detection job")

    feed = commands.add_parser("ingest", help="CSV files of a folder into the lake, as a stream")
    feed.add_argument("source", help="folder that files arrive in")
    feed.add_argument("kind", choices=["click", "purchase"])
    feed.add_argument("--lake", required=True)
    feed.add_argument("--checkpoint", required=True)
    feed.add_argument("--once", action="store_true", help="stop after the files that are there")

    summary = commands.add_parser("sessions", help="replace the session summaries of some days")
    summary.add_argument("start", type=parse_date)
    summary.add_argument("end", type=parse_date, nargs="?")
    summary.add_argument("--lake", required=True)
    summary.add_argument("--tables", required=True)

    old = commands.add_parser("expire", help="drop old date folders of a table")
    old.add_argument("table")
    old.add_argument("--tables", required=True)
    old.add_argument("--partition", default="metric_date")
    old.add_argument("--days", type=int, default=30)
    old.add_argument("--as-of", type=parse_date, default=None)

    order = commands.add_parser("sort", help="sort a CSV file by time")
    order.add_argument("csv")
    order.add_argument("out")
    order.add_argument("--column", default="Timestamp")
    return top


def run_detect(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.progress_output:
        spark.streams.addListener(ProgressListener(args.progress_output))
    schema = kafka.load_schema(args.schema) if args.schema else schemas.CLICK_AVRO
    frames = kafka.read_kafka(
        spark,
        args.click_topic,
        args.kafka_servers,
        max_offsets=args.max_offsets_per_trigger,
    )
    events = ingest.repair(kafka.decode_avro_frames(frames, schema), keep_undecodable=True)
    settings = jobs.DetectionSettings(
        watermark_minutes=args.event_time_policy_minutes, dedup_spread=args.dedup_spread
    )
    late = (args.kafka_servers, args.late_topic) if args.late_topic else None
    job = detection.start_detection_query(
        events, args.out, args.checkpoint, settings, late_kafka=late
    )
    started = {job.name: job}
    if args.console:
        started["raw"] = jobs.write_console(events, "raw_console", rows=10)
        windows = jobs.detections(events, settings)["high_frequency"]
        started["windows"] = jobs.write_console(windows, "high_frequency_console", "complete")
    jobs.run_until_any_stops(spark, started)


def load_day(
    spark: SparkSession,
    csv: str,
    kind: str,
    source_date: dt.date,
    target_date: dt.date,
    lake_root: str,
) -> None:
    """Events of one day of a CSV file, moved to another date, into the lake.

    Ids are made from the moved times. Rows that cannot be parsed go to the
    dead letters beside the events. A repeated load replaces its own rows.
    """
    read = csv_files.read_click_csv if kind == "click" else csv_files.read_purchase_csv
    valid, rejects = ingest.split_valid(read(spark, csv, target=target_date))
    # Files of one name in two folders are two loads.
    where = hashlib.sha256(csv.encode()).hexdigest()[:12]
    label = f"load-{PurePosixPath(csv).stem}-{where}-{source_date}"
    chosen = ingest.select_day(valid, source_date, "read_ts").drop("read_ts")
    lake_sink.write_lake(chosen, lake_root, kind, label)
    letters = ingest.dead_letters(rejects, f"{kind}-loader", kind)
    letters.write.mode("overwrite").parquet(
        f"{lake_root.rstrip('/')}/dead_letters/{kind}/batch={label}"
    )


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Files that arrive in a folder; rejects go to the dead letters of the lake."""
    layout = schemas.CLICK_CSV if args.kind == "click" else schemas.PURCHASE_CSV
    raw = spark.readStream.schema(layout).option("header", True).csv(args.source)
    trigger = jobs.AVAILABLE_NOW if args.once else None
    letters = f"{args.lake.rstrip('/')}/dead_letters/{args.kind}"
    jobs.start_ingest(
        raw, args.kind, args.lake, letters, args.checkpoint, trigger
    ).awaitTermination()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"millrace-{args.command}")
    if args.command == "daily":
        written = daily_jobs.run_daily(
            spark, args.lake, args.tables, args.start, args.end, args.only, args.top_n,
            args.top_categories,
        )
        for name, count in written.items():
            print(f"{name}: {count} rows")
    elif args.command == "detect":
        run_detect(spark, args)
    elif args.command == "slo":
        now = args.as_of or dt.datetime.now(dt.timezone.utc)
        anomalies = read_anomaly_table(spark, args.tables)
        print(slo.slo_report(anomalies, now, args.hours).first()[0])
    elif args.command == "compact":
        compact_anomalies(spark, args.tables)
    elif args.command == "ingest":
        run_ingest(spark, args)
    elif args.command == "sessions":
        count = daily_jobs.run_sessions(spark, args.lake, args.tables, args.start, args.end)
        print(f"session_summary: {count} rows")
    elif args.command == "expire":
        day = args.as_of or dt.datetime.now(dt.timezone.utc).date()
        path = f"{args.tables.rstrip('/')}/{args.table}"
        dropped = drop_expired_partitions(spark, path, args.partition, day, args.days)
        for row in dropped.collect():
            print(f"{row['folder']}: {row['action']}")
    elif args.command == "load":
        load_day(spark, args.csv, args.kind, args.source_date, args.target_date, args.lake)
    elif args.command == "sort":
        rows = csv_files.read_raw_csv(spark, args.csv)
        lake_sink.write_sorted(rows, args.column, args.out, "csv")
