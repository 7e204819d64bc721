"""Raw JSON files -> silver snapshots -> gold fact, summary, view and CSV."""

import glob
import json
import os

from squall import constants as K
from squall.plans import flows


def dump(path, obj):
    with open(path, "w") as f:
        json.dump(obj, f)


def test_bronze_to_gold(spark, tmp):
    land = os.path.join(tmp, "landing")
    os.makedirs(land)
    dump(os.path.join(land, "alerts_feed_1.json"), {"entity": [
        {"id": "a1", "alert": {"headerText": {"translation": [{"text": "Snow delays"}]},
                               "informedEntity": [{"routeId": "A"}],
                               "activePeriod": [{"start": "1700000000"}]}},
        {"id": "a2", "alert": {"headerText": {"translation": [{"text": "[7] signal problem"}]},
                               "descriptionText": {"translation": [{"text": "light rain expected"}]},
                               "informedEntity": [{}], "activePeriod": [{"start": "1700003000"}]}}]})
    dump(os.path.join(land, "alerts_history_1.json"), [
        {"status_id": "h1", "date": "2023-11-14T22:00:00", "affected": "L | N", "header": "Flooding",
         "agency": "Subway"}])
    dump(os.path.join(land, "forecast_1.json"), {"properties": {"periods": [
        {"startTime": "2023-11-14T17:00:00-05:00", "endTime": "2023-11-14T18:00:00-05:00",
         "temperature": 48, "shortForecast": "Light Rain"}]}})
    dump(os.path.join(land, "hourly_archive_1.json"), {"hourly": {
        "time": ["2023-11-14T21:00", "2023-11-14T23:00"], "temperature_2m": [10.0, 9.0],
        "precipitation": [0.0, 0.1], "weather_code": [71, 3]}})
    silver = os.path.join(tmp, "silver")
    assert flows.alerts_live(spark, os.path.join(land, "alerts_feed_*.json"), silver + "/alerts")["rows"] == 2
    assert flows.alerts_historical(spark, os.path.join(land, "alerts_history_*.json"),
                                   silver + "/alerts")["rows"] == 2
    assert flows.weather_live(spark, os.path.join(land, "forecast_*.json"), silver + "/weather")["rows"] == 1
    assert flows.weather_historical(spark, os.path.join(land, "hourly_archive_*.json"),
                                    silver + "/weather")["rows"] == 2
    assert flows.alerts_live(spark, os.path.join(land, "none_*.json"), silver + "/alerts")["written"] is False
    out = flows.gold_run(spark, silver + "/alerts", silver + "/weather", os.path.join(tmp, "gold"), 1)
    assert out["new_rows"] == 4
    view = sorted((r.routeId, r.weather_category, r.total_alerts) for r in spark.table(K.IMPACT_VIEW_NAME).collect())
    # a1 (snow, 22:13 UTC) -> 22:00 live hour (Light Rain); a2 (description light rain) -> 23:00 (Cloudy);
    # h1 (flood, 22:00) L and N -> 22:00 live hour
    assert view == [("7", "Cloudy/Other", 1), ("A", "Rain", 1), ("L", "Rain", 1), ("N", "Rain", 1)]
    assert glob.glob(os.path.join(tmp, "gold", "impact_export", "*.csv"))


def test_import_csv_snapshots_then_gold(spark, tmp):
    from squall import schemas
    from squall.sources.snapshots import live_and_latest_history
    src = os.path.join(tmp, "csv")
    os.makedirs(src)
    with open(os.path.join(src, "forecast_1.csv"), "w") as f:
        f.write("startTime,endTime,temperature,shortForecast\n"
                "2031-03-05 09:00:00-04:00,2031-03-05 10:00:00-04:00,61,Patchy Fog\n")
    with open(os.path.join(src, "forecast_2.csv"), "w") as f:
        f.write("shortForecast,temperature,startTime,endTime\n"
                "Windy,62,2031-03-05 09:00:00-04:00,2031-03-05 10:00:00-04:00\n")
    os.utime(os.path.join(src, "forecast_1.csv"), (1_700_000_000, 1_700_000_000))
    root = os.path.join(tmp, "silver_weather")
    assert flows.import_csv_snapshots(spark, os.path.join(src, "forecast_*.csv"), schemas.WEATHER, root, "live")["written"]
    stacked = live_and_latest_history(spark, root, schemas.WEATHER)
    assert stacked.count() == 2
    from squall.plans import gold
    # the same hour in two snapshots: the newer one wins
    assert [r.shortForecast for r in gold.prepare_weather(stacked).collect()] == ["Windy"]


def test_both_sides_empty(spark, tmp):
    from squall import schemas
    from squall.sources import sinks
    import datetime as dt
    a = spark.createDataFrame([], schemas.ALERT)
    w = spark.createDataFrame([], schemas.WEATHER)
    sinks.write_snapshot(a, os.path.join(tmp, "a"), "live", dt.datetime(2024, 1, 1))
    sinks.write_snapshot(w, os.path.join(tmp, "w"), "live", dt.datetime(2024, 1, 1))
    out = flows.gold_run(spark, os.path.join(tmp, "a"), os.path.join(tmp, "w"), os.path.join(tmp, "g"), 1)
    assert out["new_rows"] == 0 and out["summary_written"] is False


def _feed(path, *alerts):
    dump(path, {"entity": [{"id": i, "alert": {"headerText": {"translation": [{"text": text}]},
                                               "informedEntity": [{"routeId": route}],
                                               "activePeriod": [{"start": str(start)}]}} for i, route, text, start in alerts]})


def _forecast(path, *hours):
    dump(path, {"properties": {"periods": [{"startTime": s, "endTime": s, "temperature": t, "shortForecast": f}
                                           for s, t, f in hours]}})


def test_command_line_run_stream_and_import(spark, tmp):
    from squall.__main__ import main
    land, silver, gold_root = (os.path.join(tmp, x) for x in ("landing", "silver", "gold"))
    os.makedirs(land)
    _feed(os.path.join(land, "feed_1.json"), ("a", "Q", "Snow delays", 1900000000))
    _forecast(os.path.join(land, "wx_1.json"), ("2030-03-17T17:00:00Z", 41, "Blowing Snow"))
    out = main(["run", "--alert-bronze", f"{land}/feed_*.json", "--weather-bronze", f"{land}/wx_*.json", "--silver", silver,
                "--gold", gold_root, "--batch-id", "1"])
    assert out["alerts"]["rows"] == out["weather"]["rows"] == out["gold"]["new_rows"] == 1
    view = spark.newSession().table(K.IMPACT_VIEW_NAME).collect()
    assert [(r.routeId, r.weather_category) for r in view] == [("Q", "Snow")]
    # the stream reads the same landing folder: alert a is in silver already
    _feed(os.path.join(land, "feed_2.json"), ("a", "Q", "Snow delays", 1900000000), ("b", "L", "Storm", 1900000600),
          ("c", "L", "Storm", 1900090000))
    out = main(["stream", "--alert-bronze", f"{land}/feed_*.json", "--silver", silver, "--gold", gold_root,
                "--checkpoint", os.path.join(tmp, "_ck")])
    assert out == {"new_rows": 1, "pending": 1, "expired": 0}
    with open(os.path.join(tmp, "wx.csv"), "w") as f:
        f.write("shortForecast,startTime,endTime,temperature\nFog,2030-03-18T18:00:00Z,2030-03-18T19:00:00Z,40\n")
    assert main(["import-csv", "weather", "--csv", os.path.join(tmp, "wx.csv"), "--silver", silver + "/weather"])["written"]
    out = main(["stream", "--alert-bronze", f"{land}/feed_*.json", "--silver", silver, "--gold", gold_root,
                "--checkpoint", os.path.join(tmp, "_ck")])
    assert out == {"new_rows": 1, "pending": 0, "expired": 0}
