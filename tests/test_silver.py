"""Bronze -> silver on hand-made JSON files (FIXTURES cases)."""

import datetime as dt
import json
import os

import pytest

from squall.plans import silver
from squall.sources import bronze


def write(tmp, name, obj):
    path = os.path.join(tmp, name)
    with open(path, "w") as f:
        json.dump(obj, f)
    return path


def tr(text):
    return {"translation": [{"text": text, "language": "en"}]}


LIVE_FEED = {"header": {"gtfsRealtimeVersion": "2.0"}, "entity": [
    {"id": "two-by-two", "alert": {"headerText": tr("Delays"), "descriptionText": tr("Heavy rain"),
                                   "informedEntity": [{"routeId": "A", "agencyId": "A1"}, {"routeId": "C"}],
                                   "activePeriod": [{"start": "1700000000", "end": "1700003600"},
                                                    {"start": "1700086400"}]}},
    {"id": "no-period", "alert": {"headerText": tr("Weather advisory"), "informedEntity": [{"routeId": "F"}]}},
    {"id": "no-entity", "alert": {"headerText": tr("[A] gone"), "activePeriod": [{"start": "1700000000"}]}},
    {"id": "bracket", "alert": {"headerText": tr("[A] trains delayed"), "informedEntity": [{"stopId": "x"}],
                                "activePeriod": [{"start": "junk", "end": "1700000000.5"}]}},
    {"id": "two-brackets", "alert": {"headerText": tr("[B38] [A] reroute"), "informedEntity": [{"stopId": "y"}]}},
    {"id": "no-bracket", "alert": {"informedEntity": [{}]}},
    {"id": "dup", "alert": {"headerText": tr("x"), "informedEntity": [{"routeId": "Q"}, {"routeId": "Q"}]}},
]}


def test_live_alerts(spark, tmp):
    feed = bronze.live_alert_feed(spark, write(tmp, "alerts_feed_1.json", LIVE_FEED))
    rows = silver.live_alerts(feed).collect()
    by = {}
    for r in rows:
        by.setdefault(r.entity_id, []).append(r)
    assert len(by["two-by-two"]) == 4
    assert {r.routeId for r in by["two-by-two"]} == {"A", "C"}
    assert sum(r.end is None for r in by["two-by-two"]) == 2
    assert [(r.routeId, r.start) for r in by["no-period"]] == [("F", None)]
    assert by["no-period"][0].description_text == ""
    assert "no-entity" not in by
    b = by["bracket"][0]
    assert b.routeId == "A" and b.start is None and b.end is not None
    assert by["two-brackets"][0].routeId == "A"
    nb = by["no-bracket"][0]
    assert nb.routeId == "SYSTEM_WIDE" and nb.header_text == ""
    assert len(by["dup"]) == 1


def test_live_alerts_empty_feed(spark, tmp):
    feed = bronze.live_alert_feed(spark, write(tmp, "alerts_feed_0.json", {"entity": []}))
    assert silver.live_alerts(feed).count() == 0


HIST = [
    {"status_id": "1", "date": "2013-03-01T05:00:00.000", "affected": "L | N | Q", "header": "Snow",
     "description": "d", "agency": "Subway", "status_label": "x"},
    {"status_id": "2", "date": "2013-03-01T06:00:00.000", "affected": "A|B", "header": "Wind", "agency": "Subway"},
    {"status_id": "3", "date": "2013-03-01T07:00:00.000", "header": "Flood", "agency": "Subway"},
    {"status_id": "4", "date": "not a date", "affected": "", "header": "Storm", "agency": "Subway"},
    {"status_id": "5", "date": "2013-03-01T08:00:00", "affected": "  G  |  | 7", "header": "Storm"},
    {"status_id": "1", "date": "2013-03-01T05:00:00.000", "affected": "L | N | Q", "header": "Snow",
     "description": "d", "agency": "Subway", "status_label": "x"},
]


def test_historical_alerts(spark, tmp):
    recs = bronze.historical_alert_records(spark, write(tmp, "alerts_history_1.json", HIST))
    rows = silver.historical_alerts(recs).collect()
    got = sorted((r.entity_id, r.routeId) for r in rows)
    assert got == [("1", "L"), ("1", "N"), ("1", "Q"), ("2", "A|B"), ("3", "Unknown"), ("5", "7"), ("5", "G")]
    one = [r for r in rows if r.entity_id == "1"][0]
    assert (one.end - one.start) == dt.timedelta(hours=1)
    assert one.description_text == "d"


WEATHER_DOC = {"properties": {"periods": [
    {"number": 1, "startTime": "2026-11-01T00:00:00-04:00", "endTime": "2026-11-01T01:00:00-04:00",
     "temperature": 51, "shortForecast": "Partly Sunny"},
    {"number": 2, "startTime": "2026-11-01T01:00:00-05:00", "endTime": "2026-11-01T02:00:00-05:00",
     "temperature": 50.125, "shortForecast": "Snow Showers"},
    {"number": 3, "startTime": "garbage", "endTime": None, "temperature": None, "shortForecast": None},
]}}


def test_live_weather_dst_and_rounding(spark, tmp):
    doc = bronze.live_weather_doc(spark, write(tmp, "forecast_1.json", WEATHER_DOC))
    rows = silver.live_weather(doc).selectExpr("cast(startTime as timestamp_ntz) s", "temperature t",
                                              "shortForecast f").collect()
    assert [(r.s, r.t, r.f) for r in rows] == [
        (dt.datetime(2026, 11, 1, 4), 51.0, "Partly Sunny"),
        (dt.datetime(2026, 11, 1, 6), 50.12, "Snow Showers"),
        (None, None, None)]


def test_historical_weather(spark, tmp):
    doc = {"hourly": {"time": ["2012-01-01T00:00", "2012-01-01T01:00", "2012-01-01T02:00",
                               "2012-01-01T03:00", "2012-01-01T04:00", "2012-01-01T05:00", "2012-01-01T06:00"],
                      "temperature_2m": [0.0, -1.5, 10.0, 2.5, None, 3.0, 4.0],
                      "precipitation": [0, 0, 0, 0, 0, 0, 0],
                      "weather_code": [0, 3, 45, 61, 73, 95, None]}}
    d = bronze.historical_weather_doc(spark, write(tmp, "hourly_archive_1.json", doc))
    rows = silver.historical_weather(d).collect()
    assert [r.shortForecast for r in rows] == ["Clear", "Cloudy", "Cloudy/Other", "Rain", "Snow", "Storm",
                                               "Cloudy/Other"]
    assert [r.temperature for r in rows][:4] == [32.0, 29.3, 50.0, 36.5]
    assert rows[4].temperature is None
    assert all(r.endTime - r.startTime == dt.timedelta(hours=1) for r in rows)


def test_historical_weather_unequal_lengths_fail(spark, tmp):
    doc = {"hourly": {"time": ["2012-01-01T00:00", "2012-01-01T01:00"], "temperature_2m": [1.0],
                      "precipitation": [0, 0], "weather_code": [0, 0]}}
    d = bronze.historical_weather_doc(spark, write(tmp, "hourly_archive_2.json", doc))
    with pytest.raises(Exception):
        silver.historical_weather(d).collect()


def test_latest_snapshot_picks_newest_file(spark, tmp):
    old = write(tmp, "forecast_old.json", WEATHER_DOC)
    new_doc = {"properties": {"periods": [WEATHER_DOC["properties"]["periods"][0]]}}
    new = write(tmp, "forecast_new.json", new_doc)
    os.utime(old, (1_600_000_000, 1_600_000_000))
    doc = bronze.live_weather_doc(spark, [old, new])
    assert silver.live_weather(doc).count() == 1
