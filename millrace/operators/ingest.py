"""From raw records to clean events: decode repairs, parsing, late split, rejects."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas as S
from millrace.functions import times
from millrace.functions.ids import click_event_id, purchase_event_id
from millrace.functions.values import first_non_empty, normal_category


# --- repairs after decoding -------------------------------------------------


def normalise_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", times.event_time(df, "event_ts"))


def fill_ingest_time(df: DataFrame, broker_ts: str = "kafka_ingest_ts") -> DataFrame:
    """Missing or non-positive ingest time becomes the broker's time."""
    ingest = times.event_time(df, "ingest_ts")
    if isinstance(df.schema["ingest_ts"].dataType, (T.LongType, T.IntegerType)):
        ingest = F.when(F.col("ingest_ts") > 0, ingest)
    else:
        ingest = F.when(F.unix_micros(ingest) > 0, ingest)
    return df.withColumn("ingest_ts", F.coalesce(ingest, F.col(broker_ts)))


def fill_event_id(df: DataFrame) -> DataFrame:
    """A null or blank id becomes the click id over epoch milliseconds."""
    blank = F.col("event_id").isNull() | (F.length(F.trim("event_id")) == 0)
    made = click_event_id(
        F.col("session_id"),
        F.col("item_id"),
        F.unix_millis(times.event_time(df, "event_ts")),
        F.col("event_type"),
    )
    return df.withColumn("event_id", F.when(blank, made).otherwise(F.col("event_id")))


def drop_undecodable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("session_id").isNotNull())


def repair(df: DataFrame, keep_undecodable: bool = False) -> DataFrame:
    """All repairs in order; needs ``kafka_ingest_ts`` next to the event columns.

    Undecodable rows are dropped, or kept for :func:`unusable` to route.
    """
    rows = df if keep_undecodable else drop_undecodable(df)
    return fill_event_id(fill_ingest_time(normalise_event_time(rows)))


# --- late events ------------------------------------------------------------


def split_late(
    df: DataFrame, minutes: int = 10, now: object | None = None
) -> tuple[DataFrame, DataFrame]:
    """(on time, late) by the clock; without ``now`` the running clock is used.

    Rows without an event time are in neither part: see :func:`without_time`.
    """
    clock = F.current_timestamp() if now is None else now
    limit = times.minutes_before(clock, minutes)
    return df.filter(F.col("event_ts") >= limit), df.filter(F.col("event_ts") < limit)


def without_time(df: DataFrame) -> DataFrame:
    """Rows the late split cannot place; they go to the dead letters."""
    return df.filter(F.col("event_ts").isNull())


def unusable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, dead letters): rows without a session or an event time.

    The letters have a key and a JSON value with the reason.
    """
    bad = F.col("session_id").isNull() | F.col("event_ts").isNull()
    reason = F.when(F.col("session_id").isNull(), "undecodable").otherwise("no_event_time")
    return df.filter(~bad), late_payload(df.filter(bad), reason)


# The fields of a record on the late-events topic, and its reason.
def late_payload(late: DataFrame, reason: Column | None = None) -> DataFrame:
    """Key and JSON value of a record on the late-events topic."""
    fields = ["event_id", "session_id", "item_id", "event_type", "event_ts", "kafka_ingest_ts"]
    return late.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(
            F.struct(*fields, (F.lit("too_late") if reason is None else reason).alias("reason"))
        ).alias("value"),
    )


# --- parsing raw text rows --------------------------------------------------

# Fixed value: how the text of a rejected row's error begins.
FAILED = "Failed to parse row"


def _error(checks: list[tuple[Column, str]]) -> Column:
    """First failing check as text, null when all hold."""
    return F.coalesce(
        *[F.when(failed, F.lit(f"{FAILED}: {reason}")) for failed, reason in checks]
    )


def _moved(parsed: DataFrame, target: str | dt.date | None) -> DataFrame:
    """Event times on the date ``target``; ``read_ts`` keeps them as read."""
    if target is None:
        return parsed
    return rebase_date(parsed.withColumn("read_ts", F.col("event_ts")), target)


def parse_clicks(
    raw: DataFrame,
    source: str = "producer_clicks",
    now: object | None = None,
    target: str | dt.date | None = None,
) -> DataFrame:
    """Typed click columns next to ``error`` and the row as read (``original``).

    Header variants are accepted; text is parsed once and never raises. With
    ``target`` events move to that date before they get their ids.
    """
    ts = first_non_empty(raw, S.TIMESTAMP_NAMES)
    session = first_non_empty(raw, S.SESSION_NAMES)
    item = first_non_empty(raw, S.ITEM_NAMES)
    parsed = raw.select(
        F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("original"),
        ts.alias("_ts"),
        session.alias("_session"),
        item.alias("_item"),
        F.trim(session).try_cast("long").alias("session_id"),
        times.parse_iso(ts).alias("event_ts"),
        F.trim(item).try_cast("long").alias("item_id"),
        normal_category(first_non_empty(raw, S.CATEGORY_NAMES)).alias("category"),
    )
    parsed = _moved(parsed, target)
    missing = F.col("_ts").isNull() | F.col("_session").isNull() | F.col("_item").isNull()
    error = _error(
        [
            (missing, "missing required column"),
            (F.col("event_ts").isNull(), "bad timestamp"),
            (F.col("session_id").isNull(), "bad session id"),
            (F.col("item_id").isNull(), "bad item id"),
        ]
    )
    event_id = click_event_id(
        F.col("session_id"), F.col("item_id"), F.unix_millis("event_ts"), F.lit("click")
    )
    return _with_origin(parsed, "click", event_id, source, now, error)


def parse_purchases(
    raw: DataFrame,
    source: str = "producer_purchases",
    now: object | None = None,
    target: str | dt.date | None = None,
) -> DataFrame:
    """Typed purchase columns next to ``error`` and ``original``.

    The id is made from the price as read, before it becomes a decimal.
    """
    fields = {
        "_ts": S.TIMESTAMP_NAMES[:1],
        "_session": S.SESSION_NAMES[:1],
        "_item": S.ITEM_NAMES[:1],
        "_price": S.PRICE_NAMES,
        "_quantity": S.QUANTITY_NAMES,
    }
    text = {name: first_non_empty(raw, names) for name, names in fields.items()}
    parsed = raw.select(
        F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("original"),
        *[column.alias(name) for name, column in text.items()],
        F.trim(text["_session"]).try_cast("long").alias("session_id"),
        times.parse_iso(text["_ts"]).alias("event_ts"),
        F.trim(text["_item"]).try_cast("long").alias("item_id"),
        F.trim(text["_price"]).try_cast("double").alias("_amount"),
        F.trim(text["_price"]).try_cast(S.MONEY).alias("price"),
        F.trim(text["_quantity"]).try_cast("int").alias("quantity"),
    )
    parsed = _moved(parsed, target)
    missing = F.lit(False)
    for name in fields:
        missing = missing | F.col(name).isNull()
    error = _error(
        [
            (missing, "missing required column"),
            (F.col("event_ts").isNull(), "bad timestamp"),
            (F.col("session_id").isNull(), "bad session id"),
            (F.col("item_id").isNull(), "bad item id"),
            (F.col("price").isNull(), "bad price"),
            (F.col("quantity").isNull(), "bad quantity"),
        ]
    )
    event_id = purchase_event_id(
        F.col("session_id"),
        F.col("item_id"),
        F.unix_millis("event_ts"),
        F.col("quantity"),
        F.col("_amount"),
    )
    return _with_origin(parsed, "purchase", event_id, source, now, error).drop("_amount")


def _with_origin(
    parsed: DataFrame, kind: str, event_id: Column, source: str, now: object, error: Column
) -> DataFrame:
    clock = F.current_timestamp() if now is None else times.as_column(now).cast("timestamp")
    return (
        parsed.withColumn("event_type", F.lit(kind))
        .withColumn("error", error)
        .withColumn("event_id", F.when(F.col("error").isNull(), event_id))
        .withColumn("ingest_ts", clock)
        .withColumn("source", F.lit(source))
        .drop("_ts", "_session", "_item", "_price", "_quantity")
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, rejects); rejects keep ``error`` and ``original``."""
    valid = parsed.filter(F.col("error").isNull()).drop("error", "original")
    return valid, parsed.filter(F.col("error").isNotNull())


def dead_letters(
    rejects: DataFrame,
    producer: str,
    source_topic: str,
    stage: str = "parse",
    now: object | None = None,
    event: Column | None = None,
) -> DataFrame:
    """Key (session id, may be null) and JSON envelope of rejected records."""
    clock = F.current_timestamp() if now is None else times.as_column(now).cast("timestamp")
    origin = rejects.schema["original"].dataType
    names = origin.fieldNames() if isinstance(origin, T.StructType) else []
    key = F.coalesce(
        *[F.col(f"original.`{n}`").cast("string") for n in S.SESSION_NAMES if n in names],
        F.lit(None).cast("string"),
    )
    envelope = F.struct(
        F.lit(producer).alias("producer"),
        F.lit(source_topic).alias("source_topic"),
        F.lit(stage).alias("stage"),
        F.col("error"),
        F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.col("original").alias("original_data"),
        (F.lit(None).cast("string") if event is None else event).alias("event"),
    )
    return rejects.select(
        key.alias("key"), F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value")
    )


# --- moving events in time --------------------------------------------------


def select_day(df: DataFrame, day: str | dt.date, column: str = "event_ts") -> DataFrame:
    return df.filter(times.on_day(F.col(column), day))


def rebase_date(df: DataFrame, target: str | dt.date, column: str = "event_ts") -> DataFrame:
    return df.withColumn(column, times.rebase(F.col(column), target))


def shift_to(df: DataFrame, now: object, column: str = "event_ts") -> DataFrame:
    """Add one offset to all rows so that the first event happens at ``now``."""
    first = df.select(F.min(column)).scalar()
    start = times.as_column(now).cast("timestamp")
    return df.withColumn(column, F.col(column) + (start - first))


def stamp(df: DataFrame, *names: str) -> DataFrame:
    """Add the wall clock under each name (created_at, updated_at)."""
    return df.withColumns({n: F.current_timestamp() for n in names or ("created_at",)})


# --- duplicates -------------------------------------------------------------


def drop_duplicate_events(
    df: DataFrame,
    watermark: str | None = "10 minutes",
    key: str = "event_id",
    spread: int = 0,
) -> DataFrame:
    """One row per event id.

    On a stream the state is bounded by the watermark: copies that arrive
    later than the watermark delay are not recognised. ``spread`` is for
    streams where one id may have very many copies: rows are first thinned in
    that many slices per id, so the task that owns the id sees at most
    ``spread`` copies of it. It costs a second state store.

    On a static frame copies collapse inside each task before the shuffle.
    """
    if not df.isStreaming:
        return df.dropDuplicates([key])
    timed = df.withWatermark("event_ts", watermark)
    if spread > 1:
        piece = F.floor(F.rand(seed=17) * spread)
        thinned = timed.withColumn("_piece", piece).dropDuplicatesWithinWatermark([key, "_piece"])
        timed = thinned.drop("_piece")
    return timed.dropDuplicatesWithinWatermark([key])
