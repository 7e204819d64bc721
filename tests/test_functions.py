"""Scalar functions E1–E17, F3, F4 on hand-made rows."""

import datetime as dt

import pytest

from squall.functions import (categorise, code_to_label, epoch_seconds_timestamp, extract_predicate,
                              lenient_timestamp, round_dp, round_to, route_from_header,
                              strict_timestamp, strip, weather_keyword_predicate, null_to_empty)
from squall.functions.timefn import plus_seconds, utc_date

UTC = dt.timezone.utc


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_round_to_15_minutes_ties_to_even(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    secs = [0, 449, 450, 451, 1349, 1350, 1351, 2250, 3150]
    rows = [(base + dt.timedelta(seconds=s),) for s in secs]
    got = one(spark, rows, "t timestamp", round_to("t", 900).cast("timestamp_ntz"))
    mins = [(g - base).total_seconds() / 60 for g in got]
    # 07:30 -> 00 (even), 22:30 -> 30 (even), 37:30 -> 30, 52:30 -> 60
    assert mins == [0, 0, 0, 15, 15, 30, 30, 30, 60]


def test_round_to_before_1970(spark):
    t = dt.datetime(1969, 12, 31, 23, 52, 30)  # -7.5 min: tie, nearest even multiple is 0? -1 is odd -> 0
    got = one(spark, [(t,)], "t timestamp", round_to("t", 900).cast("timestamp_ntz"))
    assert got == [dt.datetime(1970, 1, 1, 0, 0)]


def test_round_dp_matches_array_rounding(spark):
    # same values as pandas Series.round(2): the product is rounded half-to-even
    got = one(spark, [(0.125,), (2.675,), (1.005,), (39.355,), (-0.125,), (None,)], "x double", round_dp("x", 2))
    assert got == [0.12, 2.68, 1.0, 39.35, -0.12, None]


def test_celsius_code_table(spark):
    codes = [0, 1, 2, 3, 45, 48, 61, 73, 95, 99, 77, None]
    got = one(spark, [(c,) for c in codes], "c int", code_to_label("c"))
    assert got == ["Clear", "Clear", "Clear", "Cloudy", "Cloudy/Other", "Cloudy/Other", "Rain", "Snow",
                   "Storm", "Storm", "Cloudy/Other", "Cloudy/Other"]


def test_forecast_category_order_and_case(spark):
    fc = ["Snow Showers", "Partly Sunny", "LIGHT RAIN", "Storm", None, "Mostly Clear", "Blizzard",
          "Hurricane Warning", "Cloudy"]
    got = one(spark, [(x,) for x in fc], "f string", categorise("f"))
    assert got == ["Rain", "Clear", "Rain", "Cloudy/Other", "Cloudy/Other", "Clear", "Snow", "Rain",
                   "Cloudy/Other"]


def test_keyword_predicate_asymmetry_and_substrings(spark):
    rows = [("light drizzle", None), (None, "light drizzle"), ("new fare policy", None),
            ("open the window", None), ("at the theater", None), ("Signal problems", "track work"),
            (None, None), ("HEAVY RAIN", None)]
    df = spark.createDataFrame(rows, "header_text string, description_text string")
    got = [r[0] for r in df.select(weather_keyword_predicate()).collect()]
    assert got == [None, True, True, True, True, False, None, True]
    kept = df.where(weather_keyword_predicate()).count()
    assert kept == 5


def test_extract_predicate_case_sensitive_and_train(spark):
    rows = [("Subway", "Train delays", None), ("Subway", "Delays in rain", None),
            ("Subway", "Snow storm", None), ("Subway", "Snow", None), ("Bus", "heavy rain", None),
            ("Subway", None, "wind advisory")]
    df = spark.createDataFrame(rows, "agency string, header string, description string")
    got = [r[0] for r in df.select(extract_predicate()).collect()]
    assert got == [None, True, True, None, False, True]


def test_route_from_header(spark):
    rows = [(None, "[A] train delays"), (None, "[B38] [A] reroute"), (None, "no bracket"),
            ("Q", "[A] ignored"), (None, None), (None, "[7] and [8]")]
    got = one(spark, rows, "r string, h string", route_from_header("r", "h"))
    assert got == ["A", "A", "SYSTEM_WIDE", "Q", "SYSTEM_WIDE", "7"]


def test_lenient_timestamp_offsets_and_junk(spark):
    rows = [("2026-06-26 15:00:00-04:00",), ("2026-11-01T01:30:00-05:00",), ("2026-06-26T05:00",),
            ("2026-06-26T05:00:00Z",), ("junk",), (None,), ("2012-01-01",)]
    got = one(spark, rows, "s string", lenient_timestamp("s").cast("timestamp_ntz"))
    assert got == [dt.datetime(2026, 6, 26, 19), dt.datetime(2026, 11, 1, 6, 30), dt.datetime(2026, 6, 26, 5),
                   dt.datetime(2026, 6, 26, 5), None, None, dt.datetime(2012, 1, 1)]


def test_strict_timestamp_fails_on_junk(spark):
    df = spark.createDataFrame([("2012-01-01T00:00",), ("bad",)], "s string")
    with pytest.raises(Exception):
        df.select(strict_timestamp("s")).collect()
    ok = spark.createDataFrame([("2012-01-01T00:00",), (None,)], "s string")
    assert len(ok.select(strict_timestamp("s")).collect()) == 2


def test_epoch_seconds(spark):
    rows = [("1500000000",), ("1500000000.5",), ("abc",), (None,), ("nan",), ("1e30",), ("-1",)]
    got = one(spark, rows, "s string", epoch_seconds_timestamp("s").cast("timestamp_ntz"))
    assert got == [dt.datetime(2017, 7, 14, 2, 40), dt.datetime(2017, 7, 14, 2, 40, 0, 500000), None, None,
                   None, None, dt.datetime(1969, 12, 31, 23, 59, 59)]


def test_plus_hour_and_utc_date(spark):
    t = dt.datetime(2024, 3, 1, 23, 30)
    df = spark.createDataFrame([(t,)], "t timestamp_ntz")
    r = df.select(plus_seconds("t", 3600).cast("timestamp_ntz").alias("e"), utc_date("t").alias("d")).first()
    assert r.e == dt.datetime(2024, 3, 2, 0, 30) and r.d == dt.date(2024, 3, 1)


def test_strip_and_empty(spark):
    got = one(spark, [("  A  ",), ("\tB\n",), ("   ",), (None,)], "s string", strip("s"))
    assert got == ["A", "B", "", None]
    got = one(spark, [(None,), (1.5,)], "x double", null_to_empty("x"))
    assert got == ["", "1.5"]


def test_lenient_timestamp_source_zone(spark):
    rows = [("2013-03-01T05:00:00",), ("2013-07-01 05:00:00",), ("2013-03-01T05:00:00Z",),
            ("2013-03-01T05:00:00-03:00",), ("junk",), ("2013-03-01",), ("2013-03-01T05:00:00.250+0100",)]
    got = one(spark, rows, "s string", lenient_timestamp("s", "America/New_York").cast("timestamp_ntz"))
    assert got == [dt.datetime(2013, 3, 1, 10), dt.datetime(2013, 7, 1, 9), dt.datetime(2013, 3, 1, 5),
                   dt.datetime(2013, 3, 1, 8), None, dt.datetime(2013, 3, 1, 5),
                   dt.datetime(2013, 3, 1, 4, 0, 0, 250000)]


def test_lenient_timestamp_fallback_layouts(spark):
    rows = [("3/1/2013 5:00",), ("3/1/2013 17:30:15",), ("3/1/2013",), ("March 1, 2013",), ("Mar 1, 2013",),
            ("13/45/2013",)]
    got = one(spark, rows, "s string", lenient_timestamp("s").cast("timestamp_ntz"))
    assert got == [dt.datetime(2013, 3, 1, 5), dt.datetime(2013, 3, 1, 17, 30, 15), dt.datetime(2013, 3, 1),
                   dt.datetime(2013, 3, 1), dt.datetime(2013, 3, 1), None]


def test_strip_matches_python(spark):
    samples = [" A ", "\x1cB\x1f", "　C ", "\xa0D\x85", "E\n", "  ", "F G"]
    got = one(spark, [(x,) for x in samples], "s string", strip("s"))
    assert got == [x.strip() for x in samples]
