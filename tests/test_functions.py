"""Identifiers, times, values."""

import datetime as dt
import hashlib

import pytest
from support import at, rows
from pyspark.sql import functions as F

from millrace.functions import ids, times, values


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_click_id_is_repeatable_and_depends_on_the_session(make):
    df = make("s long, i long, t long, k string", [(100, 42, 1700000000000, "click"),
                                                   (101, 42, 1700000000000, "click")])
    made = ids.click_event_id(F.col("s"), F.col("i"), F.col("t"), F.col("k"))
    first, second = [r[0] for r in df.select(made).collect()]
    assert first == digest("100|42|1700000000000|click")
    assert second == digest("101|42|1700000000000|click")
    assert len(first) == 64


@pytest.mark.parametrize(
    ("price", "text"),
    [(12.5, "12.5"), (100.0, "100.0"), (0.01, "0.01"), (9999999.99, "9999999.99"),
     (12345678.0, "12345678.0"), (123456789.25, "123456789.25"), (3.125, "3.125"), (0.0, "0.0")],
)
def test_price_text_matches_plain_float_text(make, price, text):
    assert repr(price) == text
    df = make("p double", [(price,)])
    assert df.select(ids.price_text(F.col("p"))).first()[0] == text


def test_purchase_id(make):
    df = make("s long, i long, t long, q int, p double", [(1, 2, 3, 4, 12345678.5)])
    made = ids.purchase_event_id(*[F.col(c) for c in "sitqp"])
    assert df.select(made).first()[0] == digest("1|2|3|4|12345678.5|purchase")


def test_alert_hash_orders_the_offsets(make):
    df = make("m map<string,long>", [({"t:1": 7, "t:0": 5},)])
    made = ids.alert_hash(F.lit("WARNING"), F.lit("t"), F.col("m"))
    assert df.select(made).first()[0] == digest('WARNING|t|{"t:0": 5, "t:1": 7}')


def test_event_time_takes_milliseconds_and_timestamps(make):
    long_form = make("t long", [(1768125600123,)])
    time_form = make("t timestamp", [(at("2026-01-11T10:00:00.123"),)])
    for df in (long_form, time_form):
        micros = df.select(F.unix_micros(times.event_time(df, "t"))).first()[0]
        assert micros == 1768125600123000


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2026-01-11T10:00:00.123Z", "2026-01-11 10:00:00.123"),
     ("2026-01-11T10:00:00+00:00", "2026-01-11 10:00:00"),
     ("2026-01-11T12:00:00+02:00", "2026-01-11 10:00:00"),
     ("not a time", None), ("", None)],
)
def test_parse_iso(make, text, expected):
    df = make("t string", [(text,)])
    assert df.select(times.parse_iso(F.col("t")).cast("string")).first()[0] == expected


def test_day_range_is_half_open(make):
    df = make("t timestamp", [(at("2026-01-10T23:59:59.999999"),), (at("2026-01-11T00:00:00"),),
                              (at("2026-01-11T23:59:59.999999"),), (at("2026-01-12T00:00:00"),)])
    assert df.filter(times.on_day(F.col("t"), "2026-01-11")).count() == 2


def test_date_range_rejects_the_wrong_order():
    with pytest.raises(ValueError):
        times.between_dates(None, "2026-01-02", "2026-01-01")
    with pytest.raises(ValueError):
        times.parse_date("2026/01/02")


def test_look_back(make):
    df = make("d date, t timestamp", [(dt.date(2026, 1, 3), at("2026-01-09T00:00:00")),
                                      (dt.date(2026, 1, 2), at("2026-01-08T23:59:59"))])
    assert df.filter(times.last_days(F.col("d"), "2026-01-10", 7)).count() == 1
    assert df.filter(times.last_hours(F.col("t"), "2026-01-10", 24)).count() == 1


def test_window_minutes_rounds_half_up(make):
    df = make("a timestamp, b timestamp", [(at("2026-01-01T00:00:00"), at("2026-01-01T00:00:10")),
                                           (at("2026-01-01T00:00:00"), at("2026-01-01T00:00:00.300"))])
    found = [r[0] for r in df.select(times.window_minutes(F.col("a"), F.col("b"))).collect()]
    assert found == [0.17, 0.01]


def test_floor_minutes(make):
    df = make("t timestamp", [(at("2026-01-01T10:19:59"),)])
    floored = df.select(times.floor_minutes(F.col("t"), 10).cast("string")).first()[0]
    assert floored == "2026-01-01 10:10:00"


def test_first_non_empty_skips_empty_and_absent_columns(make):
    df = make("Timestamp string, timestamp2 string", [("", "2026-01-11"), (None, ""), ("a", "b")])
    made = values.first_non_empty(df, ["Timestamp", "missing", "timestamp2"])
    assert [r[0] for r in df.select(made).collect()] == ["2026-01-11", None, "a"]
    assert df.select(values.first_non_empty(df, ["nothing"])).first()[0] is None


def test_normal_category(make):
    df = make("c string", [("0",), ("",), (None,), ("S",), ("12",)])
    found = [r[0] for r in df.select(values.normal_category(F.col("c"))).collect()]
    assert found == [None, None, None, "S", "12"]


def test_rounding_is_half_away_from_zero(make):
    df = make("x double", [(0.00125,), (-0.00125,), (2.5,)])
    assert [r[0] for r in df.select(values.rounded(F.col("x"), 4)).collect()] == [
        0.0013, -0.0013, 2.5]


def test_rebase_keeps_the_time_of_day(make):
    df = make("t timestamp", [(at("2014-04-01T03:05:31.743"),)])
    moved = df.select(times.rebase(F.col("t"), "2026-02-28").cast("string")).first()[0]
    assert moved == "2026-02-28 03:05:31.743"


def test_last_days_takes_a_column(make):
    df = make("d date, now date", [(dt.date(2026, 1, 3), dt.date(2026, 1, 10))])
    assert rows(df.filter(times.last_days(F.col("d"), F.col("now"), 7)).select("d"))
