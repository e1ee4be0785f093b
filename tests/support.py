"""Helpers that tests import."""

from __future__ import annotations

import datetime as dt

UTC = dt.timezone.utc


def at(text: str) -> dt.datetime:
    """A UTC time from ISO text."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def rows(df, *order):
    """Rows as plain tuples, sorted by all values unless columns are given."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=repr)
