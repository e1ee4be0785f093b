"""Lake, result tables, CSV, retention, database statements."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from support import at, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import files, schemas
from millrace.plans import daily_jobs
from millrace.session import object_store_conf, session_conf, shared_folder, work_path
from millrace.sinks import jdbc, published, tables
from millrace.sinks import lake as lake_sink
from millrace.sources import csv_files, kafka, lake
from millrace.sources import tables as result_tables

DAYS = [dt.date(2026, 1, d) for d in (10, 11, 12)]


def lake_rows(day=11, n=3, session=1):
    t = at(f"2026-01-{day}T05:30:00")
    return [(session, t + dt.timedelta(hours=i), 10 + i, "S", "click", f"{day}-{session}-{i}", t, "x")
            for i in range(n)]


@pytest.fixture
def clicks(make):
    return make(schemas.CLICK, lake_rows(11) + lake_rows(12, 2))


def test_lake_layout_and_pruned_read(spark, clicks, folder):
    lake_sink.write_lake(clicks, folder, "click", "load")
    assert Path(f"{folder}/click/dt=2026-01-11/hour=5").is_dir()
    one = lake.read_events(spark, folder, "click", "2026-01-11")
    assert rows(one, "item_id", "hour") == [(10, 5), (11, 6), (12, 7)]
    listed = one.inputFiles()
    assert listed and all("dt=2026-01-11" in name for name in listed)
    assert lake.read_events(spark, folder, "click", "2026-01-11", "2026-01-12").count() == 5
    assert lake.read_events(spark, folder, "click").count() == 5


def test_a_crowded_hour_keeps_all_rows(spark, folder):
    """One hour with nearly all rows is cut by size, nothing is lost."""
    t = F.timestamp_seconds(F.lit(1768125600) + F.when(F.col("id") % 50 == 0, 86400).otherwise(0))
    df = spark.range(60_000).select(
        F.col("id").alias("session_id"), t.alias("event_ts"), F.col("id").alias("item_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("category"), F.lit("click").alias("event_type"),
        F.col("id").cast("string").alias("event_id"), t.alias("ingest_ts"), F.lit("x").alias("source"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "262144"}
    with session_conf(spark, conf):
        lake_sink.write_lake(df.repartition(8), folder, "click", "load")
    assert len(list(Path(folder).glob("click/dt=2026-01-11/hour=10/batch=load/*.parquet"))) > 1
    stored = lake.read_events(spark, folder, "click")
    assert (stored.count(), stored.select("event_id").distinct().count()) == (60_000, 60_000)


def test_missing_source_is_empty_and_typed(spark, folder):
    empty = lake.read_events(spark, f"{folder}/none", "purchase", "2026-01-11")
    assert empty.count() == 0 and empty.schema["price"].dataType == schemas.MONEY
    Path(f"{folder}/hollow").mkdir()
    assert lake.read_or_empty(spark, f"{folder}/hollow", schemas.CLICK, infer=True).count() == 0


def test_other_read_failures_are_raised(spark, folder):
    Path(f"{folder}/bad.parquet").write_text("no parquet")
    with pytest.raises(Exception) as error:
        lake.read_or_empty(spark, f"{folder}/bad.parquet", schemas.CLICK, infer=True).count()
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_source_has_rows(spark, make, folder):
    assert not lake.source_has_rows(spark, f"{folder}/none")
    make("a int", []).write.parquet(f"{folder}/empty")
    make("a int", [(1,)]).write.parquet(f"{folder}/full")
    assert not lake.source_has_rows(spark, f"{folder}/empty")
    assert lake.source_has_rows(spark, f"{folder}/full")


def test_csv_sources(spark, folder):
    Path(f"{folder}/c.csv").write_text(
        "session_id,timestamp,Item ID,Category\n1,2026-01-11T10:00:00.000Z,5,S\n2,,5,S\n")
    parsed = csv_files.read_click_csv(spark, f"{folder}/c.csv")
    assert rows(parsed.filter("error is null"), "session_id", "item_id") == [(1, 5)]
    assert parsed.filter("error is not null").count() == 1
    Path(f"{folder}/p.csv").write_text(
        "Session ID,Timestamp,Item ID,Price,Quantity\n1,2026-01-11T10:00:00.000Z,5,12462,2\n")
    bought = csv_files.read_purchase_csv(spark, f"{folder}/p.csv").first()
    assert (bought["price"], bought["quantity"], bought["error"]) == (Decimal("12462.00"), 2, None)


def test_sorted_output(spark, make, folder):
    df = make("event_ts timestamp, n int", [(at(f"2026-01-11T00:00:{s:02d}"), s) for s in (5, 1, 9, 3)])
    lake_sink.write_sorted(df, "event_ts", f"{folder}/sorted", "csv")
    lines = [line for f in sorted(Path(f"{folder}/sorted").glob("part-*.csv"))
             for line in f.read_text().splitlines() if not line.startswith("event_ts")]
    assert [int(line.split(",")[1]) for line in lines] == [1, 3, 5, 9]


METRIC = "metric_date date, n int"


def test_replace_dates_touches_only_its_dates(spark, make, folder):
    path = f"{folder}/t"
    assert tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path) == 3
    assert tables.replace_dates(make(METRIC, [(DAYS[1], 2), (DAYS[1], 3)]), path) == 2
    assert rows(published.read(spark, path), "metric_date", "n") == [
        (DAYS[0], 1), (DAYS[1], 2), (DAYS[1], 3), (DAYS[2], 1)]


def test_replace_date_is_idempotent_and_can_empty_a_date(spark, make, folder):
    path = f"{folder}/t"
    data = make(METRIC, [(d, 1) for d in DAYS])
    tables.replace_dates(data, path)
    for _ in range(2):
        assert tables.replace_date(data.withColumn("n", F.lit(7)), path, DAYS[1], coalesce=1) == 1
    assert tables.replace_date(make(METRIC, []), path, "2026-01-12") == 0
    assert rows(published.read(spark, path), "metric_date", "n") == [(DAYS[0], 1), (DAYS[1], 7)]


def test_a_failed_replacement_leaves_the_date(spark, make, folder):
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(DAYS[0], 1)]), path)
    broken = make(METRIC, [(DAYS[0], 1)]).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        tables.replace_dates(broken, path)
    assert rows(published.read(spark, path), "n") == [(1,)]


KEYED = "k long, v int, d date"


def test_upsert_replaces_adds_and_keeps(spark, make, folder):
    path = f"{folder}/t"
    tables.upsert(make(KEYED, [(1, 1, DAYS[0]), (2, 1, DAYS[0]), (3, 1, DAYS[1])]), path, ["k"], "d", "0")
    changes = make(KEYED, [(2, 5, DAYS[0]), (2, 5, DAYS[0]), (4, 5, DAYS[2])])
    for _ in range(2):
        tables.upsert(changes, path, ["k"], "d", "1")
        assert rows(published.read(spark, path), "k", "v") == [(1, 1), (2, 5), (3, 1), (4, 5)]


def test_upsert_takes_the_newest_of_a_batch(spark, make, folder):
    path = f"{folder}/t"
    tables.upsert(make(KEYED, [(1, 1, DAYS[0]), (1, 9, DAYS[0]), (1, 4, DAYS[0])]),
                  path, ["k"], "d", "0", order=["v"])
    assert rows(published.read(spark, path), "k", "v") == [(1, 9)]


def test_a_writer_that_dies_leaves_the_old_version_whole(spark, make, folder, monkeypatch):
    """All files of a range are written, but the writer dies before the version is."""
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path)
    before = rows(published.read(spark, path))

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, "put_new", dies)
        with pytest.raises(RuntimeError):
            tables.replace_dates(make(METRIC, [(d, 2) for d in DAYS]), path)
        with pytest.raises(RuntimeError):
            tables.upsert(make(METRIC, [(DAYS[0], 5)]), path, ["metric_date"], "metric_date", "1")
    assert rows(published.read(spark, path)) == before
    assert len(files.folders(spark, f"{path}/data")) == 3
    assert len(published.vacuum(spark, path, older_than=dt.timedelta(0))) == 2
    assert rows(published.read(spark, path)) == before


def test_a_job_that_dies_between_two_partitions(spark, make, folder):
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path)
    broken = make(METRIC, [(d, 2) for d in DAYS]).withColumn(
        "n", F.when(F.col("metric_date") == F.lit(DAYS[2]), F.raise_error(F.lit("no"))).otherwise(F.col("n")).cast("int"))
    with pytest.raises(Exception):
        tables.replace_dates(broken, path, days=DAYS)
    assert rows(published.read(spark, path), "n") == [(1,)] * 3


def test_a_reader_keeps_its_version(spark, make, folder):
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path)
    old = published.read(spark, path)
    tables.replace_dates(make(METRIC, [(DAYS[1], 2)]), path)
    assert rows(old, "n") == [(1,)] * 3
    assert rows(published.read(spark, path), "n") == [(1,), (1,), (2,)]
    assert rows(published.read(spark, path, number=1), "n") == [(1,)] * 3
    wanted = published.read(spark, path, wanted=lambda f: f == f"metric_date={DAYS[1]}")
    assert rows(wanted, "n") == [(2,)] and all(str(DAYS[1]) in name for name in wanted.inputFiles())


def test_writers_at_the_same_time(spark, make, folder, monkeypatch):
    """Another writer publishes while this one is at work: both dates are in, and
    an upsert merges again."""
    path = f"{folder}/t"
    tables.upsert(make(KEYED, [(1, 1, DAYS[0]), (2, 1, DAYS[1])]), path, ["k"], "d", "0")
    real, rivals = files.put_new, [[(9, 9, DAYS[2])], [(3, 7, DAYS[0])]]

    def slower(session, name, text):
        if rivals:
            rows_of_rival = rivals.pop(0)
            with monkeypatch.context() as inner:
                inner.setattr(files, "put_new", real)
                published.append(make(KEYED, rows_of_rival), path, "d")
        return real(session, name, text)

    monkeypatch.setattr(files, "put_new", slower)
    tables.upsert(make(KEYED, [(1, 5, DAYS[0])]), path, ["k"], "d", "1")
    assert rows(published.read(spark, path), "k", "v") == [(1, 5), (2, 1), (3, 7), (9, 9)]


def test_a_batch_is_appended_once(spark, make, folder):
    path = f"{folder}/t"
    write = published.append_once(path, "d", "q")
    other = published.append_once(path, "d", "other")
    for batch_id in (0, 0, 1, 0, 1):
        write(make(KEYED, [(1, batch_id, DAYS[0])]), batch_id)
    other(make(KEYED, [(2, 5, DAYS[0])]), 0)
    write(make(KEYED, []), 2)
    assert rows(published.read(spark, path), "k", "v") == [(1, 0), (1, 1), (2, 5)]
    assert published.version(spark, path).batches == {"q": 2, "other": 0}


def test_upsert_keeps_null_keys_and_partitions(spark, make, folder):
    path = f"{folder}/t"
    tables.upsert(make(KEYED, [(1, 1, DAYS[0]), (2, 1, None), (None, 1, None)]), path, ["k"], "d", "0")
    for batch in ("1", "2"):
        tables.upsert(make(KEYED, [(1, 2, DAYS[0]), (None, 5, None)]), path, ["k"], "d", batch)
    found = rows(published.read(spark, path), "k", "v", "d")
    assert found == sorted([(1, 2, DAYS[0]), (2, 1, None), (None, 5, None)], key=repr)


def test_a_range_empties_its_days_without_rows(spark, make, folder):
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path)
    rest = make(METRIC, [(DAYS[0], 2), (DAYS[2], 2), (dt.date(2030, 1, 1), 9)])
    assert tables.replace_dates(rest, path, days=DAYS) == 2
    assert rows(published.read(spark, path), "metric_date", "n") == [(DAYS[0], 2), (DAYS[2], 2)]


def test_versions_and_compaction(spark, make, folder):
    path, target = f"{folder}/v", f"{folder}/plain"
    schema = make(KEYED, []).schema
    for batch_id, value in ((0, 1), (1, 2), (1, 3)):
        tables.append_version(make(KEYED, [(1, value, DAYS[0])]), path, batch_id, "d")
    tables.append_version(make(KEYED, [(2, 1, DAYS[1])]), path, 2, "d")
    latest = tables.latest_version(spark, path, ["k"], schema, "d")
    assert rows(latest, "k", "v") == [(1, 3), (2, 1)]
    tables.compact(spark, path, target, ["k"], schema, "d", 1)
    assert rows(published.read(spark, target), "k", "v") == [(1, 3)]
    assert files.folders(spark, path) == ["batch_id=2"]
    tables.append_version(make(KEYED, [(1, 8, DAYS[0])]), path, 3, "d")
    current = tables.current_rows(spark, path, target, ["k"], schema, "d")
    assert rows(current, "k", "v") == [(1, 8), (2, 1)]
    tables.compact(spark, path, target, ["k"], schema, "d", 3)
    assert rows(tables.current_rows(spark, path, target, ["k"], schema, "d"), "k", "v") == [
        (1, 8), (2, 1)]


def test_compaction_that_died_while_deleting(spark, make, folder, monkeypatch):
    path, target = f"{folder}/v", f"{folder}/plain"
    schema = make(KEYED, []).schema
    for batch_id in (0, 1):
        tables.append_version(make(KEYED, [(1, batch_id, DAYS[0])]), path, batch_id, "d")
    real = files.delete

    def dies(session, name):
        if "batch_id=1" in name:
            raise RuntimeError("lost")
        return real(session, name)

    with monkeypatch.context() as patch:
        patch.setattr(files, "delete", dies)
        with pytest.raises(RuntimeError):
            tables.compact(spark, path, target, ["k"], schema, "d", 1)
    assert rows(tables.current_rows(spark, path, target, ["k"], schema, "d"), "k", "v") == [(1, 1)]
    tables.compact(spark, path, target, ["k"], schema, "d", 1)
    assert rows(tables.current_rows(spark, path, target, ["k"], schema, "d"), "k", "v") == [(1, 1)]


def test_retention_drops_old_folders(spark, make, folder):
    path = f"{folder}/t"
    tables.replace_dates(make(METRIC, [(d, 1) for d in DAYS]), path)
    published.append(make("metric_date string, n int", [("unknown", 1)]), path, "metric_date")
    report = tables.drop_expired_partitions(spark, path, "metric_date", "2026-01-13", 2)
    assert rows(report, "folder", "action") == [
        ("metric_date=2026-01-10", "DROPPED"), ("metric_date=2026-01-11", "KEPT"),
        ("metric_date=2026-01-12", "KEPT"), ("metric_date=unknown", "UNREADABLE")]
    assert len(published.version(spark, path).folders) == 3


def test_daily_run_writes_all_tables(spark, make, folder, clicks):
    root, out = f"{folder}/lake", f"{folder}/tables"
    lake_sink.write_lake(clicks, root, "click", "load")
    t = at("2026-01-11T06:00:00")
    bought = make(schemas.PURCHASE, [(1, t, 10, Decimal("5.00"), 2, "purchase", "p", t, "x")])
    lake_sink.write_lake(bought, root, "purchase", "load")
    for _ in range(2):
        written = daily_jobs.run_daily(spark, root, out, "2026-01-11")
    assert written == {"daily_metrics": 1, "popular_items": 3, "popular_categories": 1,
                       "session_funnel": 3}
    daily_jobs.run_daily(spark, root, out, "2026-01-11", "2026-01-12")
    daily = result_tables.read_table(spark, out, "daily_metrics")
    assert rows(daily, "metric_date", "total_clicks", "total_revenue") == [
        (DAYS[1], 3, Decimal("10.00")), (DAYS[2], 2, None)]
    runs = result_tables.read_table(spark, out, "pipeline_runs")
    assert runs.groupBy("status").count().count() == 2 and runs.count() == 6
    with pytest.raises(ValueError):
        daily_jobs.run_daily(spark, root, out, "2026-01-20")


def test_absent_table_is_empty(spark, folder):
    assert result_tables.read_table(spark, folder, "alert_history", missing_ok=True).count() == 0
    for name in ("alert_history", "anomaly_sessions"):
        with pytest.raises(FileNotFoundError):
            result_tables.read_table(spark, folder, name)


def test_session_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_conf(spark, {key: "77", "spark.sql.made.up": "1"}):
        assert spark.conf.get(key) == "77"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.made.up", None) is None


def test_work_paths_are_new_and_below_the_shared_folder(spark):
    one, two = work_path(spark, "x"), work_path(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))


def test_object_store_settings():
    with_endpoint = object_store_conf("k", "s", endpoint="http://store:9000")
    assert with_endpoint["fs.s3a.path.style.access"] == "true"
    assert with_endpoint["fs.s3a.connection.ssl.enabled"] == "false"
    plain = object_store_conf("k", "s", region="eu-west-1")
    assert plain["fs.s3a.path.style.access"] == "false"
    assert plain["fs.s3a.endpoint.region"] == "eu-west-1"


def test_kafka_options():
    options = kafka.kafka_options("a:1", "clicks", "latest", 250_000, "g")
    assert options == {"kafka.bootstrap.servers": "a:1", "subscribe": "clicks",
                       "startingOffsets": "latest", "failOnDataLoss": "false",
                       "maxOffsetsPerTrigger": "250000", "kafka.group.id": "g"}
    assert "maxOffsetsPerTrigger" not in kafka.kafka_options("a:1", "clicks", max_offsets=None)


def test_avro_body_drops_the_frame_header(make, folder):
    df = make("value binary", [(bytearray(b"\x00\x00\x00\x00\x07body"),)])
    assert bytes(df.select(kafka.avro_body()).first()[0]) == b"body"
    Path(f"{folder}/a.avsc").write_text(schemas.CLICK_AVRO)
    assert kafka.load_schema(f"{folder}/a.avsc") == schemas.CLICK_AVRO


def test_database_statements_name_their_columns():
    delete, insert = jdbc.replace_date_statements("t", "s", ["metric_date", "n"], "2026-01-11")
    assert delete == "DELETE FROM t WHERE metric_date = DATE '2026-01-11'"
    assert insert == ("INSERT INTO t (metric_date, n) SELECT metric_date, n FROM s "
                      "WHERE metric_date = DATE '2026-01-11'")
    with pytest.raises(ValueError):
        jdbc.replace_date_statements("t", "s", ["n"], "2026-01-11'; --")
    names = {jdbc.staging_name("public.x", f"{q}_{b}") for q in ("hf", "bot") for b in (0, 1)}
    assert len(names) == 4 and all(name.startswith("public._staging_x_") for name in names)
    text = jdbc.upsert_statement("t", "s", ["k", "v"], ["k"], ["updated_at"])
    assert text == ("INSERT INTO t (k, v, updated_at) SELECT k, v, CURRENT_TIMESTAMP FROM s "
                    "WHERE TRUE ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v, "
                    "updated_at = CURRENT_TIMESTAMP")


def test_a_replayed_batch_appends_nothing():
    """The statements of the transaction, run as SQL."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT, v BIGINT)")
    con.execute(jdbc.ledger_statement())

    def send(query, batch_id, values):
        staging = jdbc.staging_name("t", f"{query}_{batch_id}")
        con.execute(f"CREATE TABLE {staging} (k BIGINT, v BIGINT)")
        con.executemany(f"INSERT INTO {staging} VALUES (?, ?)", values)
        con.begin()
        for text in jdbc.append_statements("t", staging, ["k", "v"], query, batch_id):
            con.execute(text)
        con.commit()
        con.execute(f"DROP TABLE {staging}")

    for _ in range(3):
        send("q", 0, [(1, 1), (2, 1)])
    send("other", 0, [(5, 5)])
    send("q", 1, [(3, 1)])
    send("q", 0, [(1, 1)])
    assert sorted(con.execute("SELECT * FROM t").fetchall()) == [(1, 1), (2, 1), (3, 1), (5, 5)]
    send("q", 1500, [(9, 9)])
    assert con.execute("SELECT batch_id FROM stream_batches WHERE query_name = 'q'").fetchall() == [(1500,)]
    for bad in ("a'b", "", "x y"):
        with pytest.raises(ValueError):
            jdbc.append_statements("t", "s", ["k"], bad, 0)


def test_a_row_without_a_score_deletes_its_key():
    """The statements of the transaction, run as SQL."""
    import duckdb

    con = duckdb.connect()
    for name in ("t", "s"):
        con.execute(f"CREATE TABLE {name} (k BIGINT PRIMARY KEY, anomaly_score DOUBLE)")
    con.execute("INSERT INTO t VALUES (1, 1), (2, 1), (3, 1)")
    con.execute("INSERT INTO s VALUES (1, 2), (2, NULL), (4, NULL), (5, 1)")
    con.execute(jdbc.upsert_statement(
        "t", "s", ["k", "anomaly_score"], ["k"], where="anomaly_score IS NOT NULL"))
    con.execute(jdbc.retract_statement("t", "s", ["k"], "anomaly_score IS NULL"))
    assert sorted(con.execute("SELECT * FROM t").fetchall()) == [(1, 2.0), (3, 1.0), (5, 1.0)]


def test_backoff_doubles_up_to_a_limit():
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise ConnectionError

    with pytest.raises(ConnectionError):
        jdbc.with_backoff(fails, sleep=waits.append)
    assert (len(calls), waits) == (6, [1, 2, 4, 8, 8])
    jdbc.with_backoff(lambda: None)
    for bad in ({"attempts": 0}, {"first_delay": -1}):
        with pytest.raises(ValueError):
            jdbc.with_backoff(fails, **bad)
    with pytest.raises(ValueError):
        jdbc.jdbc_options("h", 5432, "d", "u", "")


def test_catalogue_retention(spark, make):
    table = "retention_probe"
    df = make(METRIC, [(d, 1) for d in DAYS])
    df.write.mode("overwrite").partitionBy("metric_date").saveAsTable(table)
    try:
        tables.drop_expired_catalog_partitions(spark, table, "metric_date", "2026-01-13", 2)
        assert rows(spark.table(table), "metric_date") == [(DAYS[1],), (DAYS[2],)]
    finally:
        spark.sql(f"DROP TABLE {table}")
