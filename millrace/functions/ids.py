"""Deterministic identifiers, all SHA-256 over '|'-joined text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import MONEY


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def click_event_id(session: Column, item: Column, ts_ms: Column, event_type: Column) -> Column:
    return _digest(session, item, ts_ms, event_type)


def price_text(price: Column) -> Column:
    """A price as plain text with at least one decimal: 12.5, 100.0, 12345678.0.

    Two-digit prices go through DECIMAL so that large ones never turn into
    scientific notation; anything finer keeps the double's own text.
    """
    exact = price.try_cast(MONEY)
    plain = F.regexp_replace(exact.cast("string"), r"(\.\d)0$", "$1")
    return F.when(exact.cast("double") == price.cast("double"), plain).otherwise(
        price.cast("double").cast("string")
    )


def purchase_event_id(
    session: Column, item: Column, ts_ms: Column, quantity: Column, price: Column
) -> Column:
    return _digest(session, item, ts_ms, quantity, price_text(price), F.lit("purchase"))


def anomaly_id(session: Column, window_start: Column, anomaly_type: str) -> Column:
    """Id of one (session, window, type); stable when late events join the window."""
    return _digest(session, F.unix_millis(window_start), F.lit(anomaly_type))


def offsets_text(offsets: Column) -> Column:
    """An offset map as JSON with ordered keys: {"t:0": 5, "t:1": 7}."""
    entries = F.array_sort(F.map_entries(offsets))
    parts = F.transform(
        entries,
        lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"].cast("string")),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def alert_hash(severity: Column, topic: Column, offsets: Column) -> Column:
    """Digest of an alert over its severity, topic and partition offsets."""
    return _digest(severity, topic, offsets_text(offsets))
