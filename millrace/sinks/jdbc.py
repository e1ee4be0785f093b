"""Writers for result tables in a database, over Spark's JDBC source.

Rows travel from the executors to the database; the driver only runs the
closing transaction, one statement per step. The database's JDBC driver must
be on the class path.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import parse_date


def jdbc_options(
    host: str, port: int, database: str, user: str, password: str, batch_size: int = 1000
) -> dict[str, str]:
    if not password:
        raise ValueError("a password is required")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "batchsize": str(batch_size),
        "isolationLevel": "READ_COMMITTED",
    }


def write_table(
    df: DataFrame, options: dict[str, str], table: str, mode: str = "append"
) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def staging_name(table: str, tag: str) -> str:
    """A table beside ``table``, in its schema, for one writer: ``tag`` tells
    queries and batches apart."""
    schema, _, name = table.rpartition(".")
    safe = re.sub(r"\W", "_", tag)
    return f"{schema + '.' if schema else ''}_staging_{name}_{safe}"


def replace_date_statements(
    table: str,
    staging: str,
    columns: Sequence[str],
    date: str | dt.date,
    date_column: str = "metric_date",
) -> list[str]:
    """Delete one date and refill it from staging, column by column name."""
    names = ", ".join(columns)
    day = f"DATE '{parse_date(date).isoformat()}'"
    return [
        f"DELETE FROM {table} WHERE {date_column} = {day}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE {date_column} = {day}",
    ]


#: Table of the batches that are in: one row for each query and batch.
LEDGER = "stream_batches"
#: Older batches than so many before the newest are forgotten.
LEDGER_DEPTH = 1000


def ledger_statement(ledger: str = LEDGER) -> str:
    """The key makes the second of two writers of one batch fail."""
    return (
        f"CREATE TABLE IF NOT EXISTS {ledger} (query_name VARCHAR(200) NOT NULL, "
        "batch_id BIGINT NOT NULL, PRIMARY KEY (query_name, batch_id))"
    )


def append_statements(
    table: str,
    staging: str,
    columns: Sequence[str],
    query: str,
    batch_id: int,
    ledger: str = LEDGER,
) -> list[str]:
    """Append staging and enter the batch in the ledger, or neither if it is there."""
    if not re.fullmatch(r"[\w.-]{1,200}", query):
        raise ValueError(f"not a name of a query: {query!r}")
    names, batch = ", ".join(columns), int(batch_id)
    same = f"query_name = '{query}' AND batch_id"
    unseen = f"NOT EXISTS (SELECT 1 FROM {ledger} WHERE {same} = {batch})"
    return [
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} WHERE {unseen}",
        f"INSERT INTO {ledger} (query_name, batch_id) SELECT '{query}', {batch} WHERE {unseen}",
        f"DELETE FROM {ledger} WHERE {same} < {batch - LEDGER_DEPTH}",
    ]


def append_batch(
    options: dict[str, str], table: str, query: str, ledger: str = LEDGER
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends each micro-batch of ``query`` once.

    Rows go to a staging table of the batch first; one transaction then moves
    them and enters the batch in the ledger. A batch that is repeated is found
    there and adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = staging_name(table, f"{query}_{batch_id}")
        write_table(batch, options, staging, "overwrite")
        steps = append_statements(table, staging, batch.columns, query, batch_id, ledger)
        run_transaction(
            batch.sparkSession, options, [ledger_statement(ledger), *steps, f"DROP TABLE {staging}"]
        )

    return write


def upsert_statement(
    table: str,
    staging: str,
    columns: Sequence[str],
    keys: Sequence[str],
    stamps: Sequence[str] = (),
    where: str = "TRUE",
) -> str:
    """Insert from staging; on a known key update the other columns.

    ``stamps`` are columns the database sets to its own clock.
    """
    names = ", ".join([*columns, *stamps])
    values = ", ".join([*columns, *["CURRENT_TIMESTAMP"] * len(stamps)])
    updates = [f"{c} = EXCLUDED.{c}" for c in columns if c not in keys]
    updates += [f"{c} = CURRENT_TIMESTAMP" for c in stamps]
    return (
        f"INSERT INTO {table} ({names}) SELECT {values} FROM {staging} WHERE {where} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {', '.join(updates)}"
    )


def retract_statement(table: str, staging: str, keys: Sequence[str], where: str) -> str:
    """Delete the keys of the staging rows that ``where`` holds for."""
    same = " AND ".join(f"{staging}.{k} = {table}.{k}" for k in keys)
    return f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same} AND {staging}.{where})"


def run_transaction(
    spark: SparkSession, options: dict[str, str], statements: Sequence[str]
) -> None:
    """Run the statements in one transaction, or none of them."""
    jvm = spark.sparkContext._jvm
    # Spark's class loader also sees drivers that came with --jars.
    loader = jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
    driver = loader.loadClass(options["driver"]).getDeclaredConstructor().newInstance()
    properties = jvm.java.util.Properties()
    for key in ("user", "password"):
        properties.setProperty(key, options[key])
    connection = driver.connect(options["url"], properties)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            try:
                statement.executeUpdate(text)
            finally:
                statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def replace_date(
    df: DataFrame,
    options: dict[str, str],
    table: str,
    date: str | dt.date,
    coalesce: int | None = None,
    date_column: str = "metric_date",
) -> None:
    """Replace one date of a database table through a staging table of its own.

    Rows of other dates are left out.
    """
    day = parse_date(date)
    rows = df.filter(F.col(date_column) == F.lit(day))
    staging = staging_name(table, f"{day.isoformat()}_{uuid.uuid4().hex[:8]}")
    write_table(rows.coalesce(coalesce) if coalesce else rows, options, staging, "overwrite")
    steps = replace_date_statements(table, staging, df.columns, day, date_column)
    run_transaction(df.sparkSession, options, [*steps, f"DROP TABLE {staging}"])


def with_backoff(
    action: Callable[[], None],
    attempts: int = 6,
    first_delay: float = 1.0,
    longest_delay: float = 8.0,
    retry_on: tuple[type[BaseException], ...] = (ConnectionError,),
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run ``action``; on a connection error wait 1, 2, 4, 8, 8 ... s and retry."""
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    if first_delay < 0 or longest_delay < 0:
        raise ValueError("delays must not be negative")
    for attempt in range(1, attempts + 1):
        try:
            action()
            return
        except retry_on:
            if attempt == attempts:
                raise
            sleep(min(first_delay * 2 ** (attempt - 1), longest_delay))


def upsert_batch(
    options: dict[str, str],
    table: str,
    keys: Sequence[str] = ("session_id", "window_start", "anomaly_type"),
    query: str = "batch",
    attempts: int = 6,
    retry_on: tuple[type[BaseException], ...] | None = None,
    score: str = "anomaly_score",
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that upserts through a staging table.

    Rows whose ``score`` is null delete their key, if there is such a column.
    ``query`` names the stream: queries that write one table have staging
    tables of their own. A batch is computed once, however often it is retried.
    """
    if retry_on is None:
        from py4j.protocol import Py4JJavaError

        retry_on = (Py4JJavaError, ConnectionError)

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = staging_name(table, f"{query}_{batch_id}")
        rows = batch.dropDuplicates(list(keys)).persist()

        def once() -> None:
            write_table(rows, options, staging, "overwrite")
            scored = score in rows.columns
            steps = [
                upsert_statement(
                    table,
                    staging,
                    rows.columns,
                    keys,
                    stamps=("db_write_ts", "updated_at"),
                    where=f"{score} IS NOT NULL" if scored else "TRUE",
                )
            ]
            if scored:
                steps.append(retract_statement(table, staging, keys, f"{score} IS NULL"))
            run_transaction(batch.sparkSession, options, [*steps, f"DROP TABLE {staging}"])

        try:
            with_backoff(once, attempts, retry_on=retry_on)
        finally:
            rows.unpersist()

    return write
