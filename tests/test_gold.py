"""Gold: stacking, keyed dedup, summary, view, idempotent fact, export (FIXTURES cases)."""

import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from squall import constants as K
from squall import schemas
from squall.operators.aggregates import daily_summary, impact_aggregate
from squall.operators.anti_join import anti_join_null_safe
from squall.operators.union import stack
from squall.plans import gold
from squall.sources import commits, sinks
from squall.sources.snapshots import read_csv_by_name

UTC = dt.timezone.utc
T = dt.datetime(2024, 1, 1, 12, 0, 0)


def alert_df(spark, rows):
    return spark.createDataFrame(rows, schemas.ALERT)


def weather_df(spark, rows):
    return spark.createDataFrame(rows, schemas.WEATHER)


def test_prepare_alerts_keeps_history_first_and_drops_null_start(spark):
    hist = spark.createDataFrame([("1", "A", "2024-01-01 12:00:00", "hist", "")],
                                 "entity_id string, routeId string, start string, header_text string, description_text string")
    live = spark.createDataFrame([("1", "A", "2024-01-01T12:00:00+00:00", "live"), ("2", "B", "junk", "x")],
                                 "entity_id string, routeId string, start string, header_text string")
    out = gold.prepare_alerts(stack([(hist, "historical"), (live, "live")])).collect()
    assert len(out) == 1
    assert out[0].header_text == "hist" and out[0].description_text is None and out[0].end is None


def test_prepare_weather_one_row_per_hour(spark):
    h = weather_df(spark, [(T, T + dt.timedelta(hours=1), 40.0, "Cloudy")])
    l1 = weather_df(spark, [(T, T + dt.timedelta(hours=1), 41.0, "Sunny")]).withColumn(
        "ingest_ts", F.lit(dt.datetime(2024, 1, 1, 10)).cast("timestamp"))
    l2 = weather_df(spark, [(T, T + dt.timedelta(hours=1), 42.0, "Snow")]).withColumn(
        "ingest_ts", F.lit(dt.datetime(2024, 1, 1, 11)).cast("timestamp"))
    s = stack([(h, "historical"), (l1, "live"), (l2, "live")])
    out = gold.prepare_weather(s).collect()
    assert [(r.temperature, r.shortForecast) for r in out] == [(42.0, "Snow")]


def test_combine_and_summary(spark):
    alerts = alert_df(spark, [
        ("1", "A", T, None, "h", "d"), ("2", "A", T + dt.timedelta(minutes=20), None, "h", "d"),
        ("3", "A", T + dt.timedelta(hours=5), None, "h", "d"), ("4", None, T, None, "h", "d"),
        ("1", "B", T + dt.timedelta(minutes=50), None, "h", "d")])
    wx = weather_df(spark, [(T, T + dt.timedelta(hours=1), 40.0, "Snow"),
                            (T + dt.timedelta(hours=1), T + dt.timedelta(hours=2), 50.0, "Rain")])
    g = gold.combine(alerts, wx)
    assert g.columns == schemas.GOLD.fieldNames()
    assert g.count() == 4  # alert 3 is 4 h from the nearest hour
    s = {(r.routeId): r for r in gold.summarize(g).collect()}
    assert set(s) == {"A", "B"}  # the null route is not summarised
    assert (s["A"].entity_id, s["A"].temperature, s["A"].shortForecast) == (2, 40.0, "Snow")
    assert (s["B"].entity_id, s["B"].temperature, s["B"].shortForecast) == (1, 50.0, "Rain")


def test_mode_ties_take_smallest_and_null_forecasts(spark):
    rows = [("1", "A", T, "Rain"), ("2", "A", T, "Clear"), ("3", "B", T, None)]
    df = spark.createDataFrame(rows, "entity_id string, routeId string, weather_start timestamp, shortForecast string")
    df = df.withColumn("temperature", F.lit(1.0))
    s = {r.routeId: r.shortForecast for r in daily_summary(df).collect()}
    assert s == {"A": "Clear", "B": None}


def test_impact_view_keeps_null_routes(spark):
    rows = [("1", None, T, "Snow storm", None, "Snow Showers"), ("2", None, T, "police", "drizzle", "Snow Showers"),
            ("3", "A", T, "delays", None, "Sunny"), ("4", "A", T, "heavy rain", None, None)]
    df = spark.createDataFrame(rows, "entity_id string, routeId string, weather_start timestamp, "
                                     "header_text string, description_text string, shortForecast string")
    got = sorted((r.routeId or "", r.weather_category, r.total_alerts) for r in impact_aggregate(df).collect())
    assert got == [("", "Rain", 2), ("A", "Cloudy/Other", 1)]


def test_anti_join_null_keys_equal(spark):
    new = spark.createDataFrame([("1", None, T, None), ("2", "A", T, "h"), ("2", "A", T, "h")],
                                "entity_id string, routeId string, weather_start timestamp, header_text string")
    old = spark.createDataFrame([("1", None, T, None), ("1", None, T, None)], new.schema)
    out = anti_join_null_safe(new, old, ["entity_id", "routeId", "weather_start", "header_text"]).collect()
    assert sorted(r.entity_id for r in out) == ["2", "2"]


def gold_rows(spark, n=3, header=None):
    rows = [(str(i), "A" if i else None, T, T + dt.timedelta(hours=1), header, None,
             T + dt.timedelta(minutes=7, seconds=30), T + dt.timedelta(hours=1), 40.0, "Snow") for i in range(n)]
    return spark.createDataFrame(rows, schemas.GOLD)


def test_append_twice_is_idempotent_with_null_keys(spark, tmp):
    path = os.path.join(tmp, "fact")
    g = gold_rows(spark)
    assert sinks.append_new(g, path, 1) == {"new_rows": 3}
    assert sinks.append_new(g, path, 2) == {"new_rows": 0}
    fact = sinks.read_fact(spark, path)
    assert fact.count() == 3
    assert {r.weather_start.replace(tzinfo=None) for r in fact.select(
        F.col("weather_start").cast("timestamp_ntz").alias("weather_start")).collect()} == {T}


def test_retried_batch_replaces_itself(spark, tmp):
    path = os.path.join(tmp, "fact")
    sinks.append_new(gold_rows(spark, 2), path, 5)
    sinks.append_new(gold_rows(spark, 2), path, 5)
    assert sinks.read_fact(spark, path).count() == 2
    sinks.append_new(gold_rows(spark, 4), path, 6)
    assert sinks.read_fact(spark, path).count() == 4


def test_retry_with_fewer_dates_replaces_the_batch(spark, tmp):
    path = os.path.join(tmp, "fact")
    day = F.col("weather_start") + F.make_dt_interval(days=F.col("entity_id").cast("int"))
    rows = gold_rows(spark, 3).withColumn("weather_start", day)
    assert sinks.append_new(rows, path, 5) == {"new_rows": 3}
    assert sinks.append_new(rows.where("entity_id = '1'"), path, 5) == {"new_rows": 1}
    assert [r.entity_id for r in sinks.read_fact(spark, path).collect()] == ["1"]
    assert sinks.append_new(rows.where("false"), path, 5) == {"new_rows": 0}
    assert sinks.read_fact(spark, path).count() == 0


def test_a_batch_cut_off_before_its_commit_stays_as_it_was(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "fact")
    sinks.append_new(gold_rows(spark, 3), path, 5)
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.append_new(gold_rows(spark, 2), path, 5)
        assert len(glob.glob(f"{path}/data/attempt=*")) == 2
    assert sinks.read_fact(spark, path).count() == 3
    sinks.append_new(gold_rows(spark, 2), path, 5)
    assert sinks.read_fact(spark, path).count() == 2
    assert commits.vacuum(spark, path, keep_seconds=-1) == {"attempts": 2, "commits": 1}
    assert sinks.read_fact(spark, path).count() == 2


def test_compaction_keeps_rows_and_batches(spark, tmp):
    path = os.path.join(tmp, "fact")
    assert commits.compact(spark, path) == {"batches": 0, "attempts": 0} and sinks.read_fact(spark, path) is None
    for i in range(4):
        sinks.append_new(gold_rows(spark, 6).where(f"entity_id % 4 = {i}"), path, i)
    seen = sorted(map(str, sinks.read_fact(spark, path).collect()))
    view = sinks.create_view(spark, path, "impact_compacted").collect()
    assert commits.compact(spark, path) == {"batches": 4, "attempts": 4}
    assert commits.vacuum(spark, path, keep_seconds=-1) == {"attempts": 4, "commits": 4}
    assert len(glob.glob(f"{path}/data/*/*/*.parquet")) == 1
    assert sorted(map(str, sinks.read_fact(spark, path).collect())) == seen
    assert spark.table("impact_compacted").collect() == view
    assert sinks.append_new(gold_rows(spark, 6), path, 9) == {"new_rows": 0}
    # a batch inside the compacted files is replaced like any other
    assert sinks.append_new(gold_rows(spark, 6).where("entity_id = 2"), path, 2) == {"new_rows": 1}
    assert {(r.entity_id, r.batch_id) for r in sinks.read_fact(spark, path).collect()} == {
        ("0", 0), ("4", 0), ("1", 1), ("5", 1), ("2", 2), ("3", 3)}
    assert commits.holds(spark, path, 9) and not commits.holds(spark, path, 10)


def test_compaction_yields_to_a_batch_appended_meanwhile(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "fact")
    for i in range(2):
        sinks.append_new(gold_rows(spark, 4).where(f"entity_id % 2 = {i}"), path, i)
    write = commits.write_attempt

    def slow(rows, where, attempt):
        write(rows, where, attempt)
        monkeypatch.setattr(commits, "write_attempt", write)
        sinks.append_new(gold_rows(spark, 1), path, 0)

    monkeypatch.setattr(commits, "write_attempt", slow)
    with pytest.raises(commits.Conflict):
        commits.compact(spark, path)
    assert {(r.entity_id, r.batch_id) for r in sinks.read_fact(spark, path).collect()} == {("0", 0), ("1", 1), ("3", 1)}


@pytest.mark.parametrize("bound", [10_000, 0])
def test_null_dates_append_once_on_both_sides_of_the_bound(spark, tmp, monkeypatch, bound):
    monkeypatch.setattr(sinks, "MAX_PRUNED_DATES", bound)
    path = os.path.join(tmp, "fact")
    rows = gold_rows(spark, 4).withColumn("weather_start", F.when(F.col("entity_id") > "1", F.col("weather_start")))
    assert sinks.append_new(rows, path, 1) == {"new_rows": 4}
    assert sinks.append_new(rows, path, 2) == {"new_rows": 0}
    assert sinks.read_fact(spark, path).where("weather_date IS NULL").count() == 2


def test_view_is_seen_by_other_sessions_and_follows_the_fact(spark, tmp):
    path = os.path.join(tmp, "fact")
    sinks.append_new(gold_rows(spark, 2, "Snow storm"), path, 1)
    view = sinks.create_view(spark, path, "impact_shared")
    assert view.columns == schemas.VIEW.fieldNames()
    sinks.append_new(gold_rows(spark, 3, "Snow storm"), path, 2)
    got = spark.newSession().table("impact_shared").collect()
    assert sum(r.total_alerts for r in got) == 3
    assert sorted(got, key=str) == sorted(impact_aggregate(sinks.read_fact(spark, path)).collect(), key=str)


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp):
    with open(os.path.join(tmp, "alerts.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["entity_id", "start", "header_text", "description_text"])
        w.writerow(["1", "2031-01-01T00:00:00Z", 'Say "Snow", twice', "line one\nline two, still two"])
        w.writerow(["2", "2031-01-01T01:00:00Z", "plain", ""])
    rows = sorted(read_csv_by_name(spark, os.path.join(tmp, "*.csv"), schemas.ALERT).collect(), key=lambda r: r.entity_id)
    assert [(r.entity_id, r.header_text, r.description_text) for r in rows] == [
        ("1", 'Say "Snow", twice', "line one\nline two, still two"), ("2", "plain", None)]
    assert all(r.start is not None for r in rows)


def test_csv_names_with_spaces(spark, tmp):
    os.makedirs(os.path.join(tmp, "a folder"))
    with open(os.path.join(tmp, "a folder", "x y%20.csv"), "w") as f:
        f.write("startTime,shortForecast\n2031-01-01T00:00:00Z,Fog\n")
    assert read_csv_by_name(spark, os.path.join(tmp, "a folder", "*.csv"), schemas.WEATHER).first().shortForecast == "Fog"


def test_csv_of_many_headers_and_widths_is_one_scan(spark, tmp):
    for i in range(12):
        with open(os.path.join(tmp, f"w{i:02}.csv"), "w") as f:
            if i % 3 == 0:
                f.write(f"shortForecast\nFog {i}\n")
            elif i % 3 == 1:
                f.write(f"extra,temperature,shortForecast,more,temperature\nx,{i},Rain {i},y,99\n")
            else:
                f.write(f'startTime,shortForecast\n2031-01-01T{i:02}:00:00Z,"Snow, {i}",beyond\n2031-01-01T{i:02}:30:00Z\n')
    open(os.path.join(tmp, "empty.csv"), "w").close()
    df = read_csv_by_name(spark, os.path.join(tmp, "*.csv"), schemas.WEATHER)
    got = [(r.shortForecast, r.temperature, r.startTime and r.startTime.minute) for r in df.collect()]
    wanted = [*((f"Fog {i}", None, None) for i in (0, 3, 6, 9)), *((f"Rain {i}", float(i), None) for i in (1, 4, 7, 10)),
              *((f"Snow, {i}", None, 0) for i in (2, 5, 8, 11)), *((None, None, 30) for _ in range(4))]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert str(df._jdf.queryExecution().optimizedPlan()).count("] csv") == 1  # the other scan reads header lines as text


def test_mean_is_not_rounded(spark):
    rows = [(str(i), "A", T, x, "x") for i, x in enumerate([70.1, 70.2, 70.1])] + [("9", "B", T, 1.23456, "x")]
    df = spark.createDataFrame(rows, "entity_id string, routeId string, weather_start timestamp, "
                                     "temperature double, shortForecast string")
    got = {r.routeId: r.temperature for r in daily_summary(df).collect()}
    assert got == {"A": 210.4 / 3, "B": 1.23456}


def test_csv_by_name_aligns_swapped_columns(spark, tmp):
    with open(os.path.join(tmp, "forecast_a.csv"), "w") as f:
        f.write("startTime,endTime,temperature,shortForecast\n")
        f.write("2031-03-05 09:00:00-04:00,2031-03-05 10:00:00-04:00,61,Patchy Fog\n")
    with open(os.path.join(tmp, "forecast_b.csv"), "w") as f:
        f.write("shortForecast,temperature,endTime,startTime\n")
        f.write("Windy,62.5,2031-03-05T11:00:00-04:00,2031-03-05T10:00:00-04:00\n")
    df = read_csv_by_name(spark, os.path.join(tmp, "forecast_*.csv"), schemas.WEATHER)
    rows = sorted(df.selectExpr("cast(startTime as timestamp_ntz) s", "temperature", "shortForecast").collect())
    assert [(r.s, r.temperature, r.shortForecast) for r in rows] == [
        (dt.datetime(2031, 3, 5, 13), 61.0, "Patchy Fog"), (dt.datetime(2031, 3, 5, 14), 62.5, "Windy")]


def test_run_gold_end_to_end(spark, tmp):
    alerts_root, weather_root, gold_root = (os.path.join(tmp, x) for x in ("alerts", "weather", "gold"))
    hist_alerts = alert_df(spark, [("h1", "A", T, None, "Snow storm", None)])
    live_alerts = alert_df(spark, [("l1", "B", T + dt.timedelta(hours=30), None, "Signal", "light rain"),
                                   ("h1", "A", T, None, "Snow storm", None)])
    assert sinks.write_snapshot(hist_alerts, alerts_root, "historical", dt.datetime(2024, 1, 1)) == {"rows": 1}
    sinks.write_snapshot(live_alerts, alerts_root, "live", dt.datetime(2024, 1, 2))
    wx_hist = weather_df(spark, [(T, T + dt.timedelta(hours=1), 30.0, "Snow")])
    wx_live = weather_df(spark, [(T + dt.timedelta(hours=30), T + dt.timedelta(hours=31), 50.0, "Rain")])
    sinks.write_snapshot(wx_hist, weather_root, "historical", dt.datetime(2024, 1, 1))
    sinks.write_snapshot(wx_live, weather_root, "live", dt.datetime(2024, 1, 2))
    m1 = gold.run_gold(spark, alerts_root, weather_root, gold_root, batch_id=1)
    m2 = gold.run_gold(spark, alerts_root, weather_root, gold_root, batch_id=2)
    assert m1["new_rows"] == 2 and m2["new_rows"] == 0
    view = spark.table(K.IMPACT_VIEW_NAME).collect()
    assert sorted((r.routeId, r.weather_category) for r in view) == [("A", "Snow"), ("B", "Rain")]
    csv = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(gold_root, "impact_export", "*.csv"))))
    assert "routeId,weather_start,weather_category,total_alerts" in csv
    assert "A,2024-01-01 12:00:00+00:00,Snow,1" in csv
    summary = spark.read.parquet(os.path.join(gold_root, "daily_summary")).count()
    assert summary == 2


def test_run_gold_with_missing_inputs(spark, tmp):
    out = gold.run_gold(spark, os.path.join(tmp, "none1"), os.path.join(tmp, "none2"), os.path.join(tmp, "g"), 1)
    assert out == {"status": "missing silver input"}


def _silver(spark, root, alerts=None, weather=None, source="live"):
    if alerts is not None:
        sinks.write_snapshot(alert_df(spark, alerts), root + "/alerts", source, dt.datetime(2024, 1, 2))
    if weather is not None:
        sinks.write_snapshot(weather_df(spark, weather), root + "/weather", source, dt.datetime(2024, 1, 2))


def test_only_history_or_only_live(spark, tmp):
    a = [("1", "A", T, None, "Snow", None)]
    w = [(T, T + dt.timedelta(hours=1), 30.0, "Snow")]
    for src in ("historical", "live"):
        root = os.path.join(tmp, src)
        _silver(spark, root, a, w, source=src)
        out = gold.run_gold(spark, root + "/alerts", root + "/weather", root + "/gold", 1, export=False)
        assert out["new_rows"] == 1


def test_no_bronze_file_is_empty(spark, tmp):
    from squall.plans import silver
    from squall.sources import bronze
    feed = bronze.live_alert_feed(spark, os.path.join(tmp, "feed_*.json"))
    assert silver.live_alerts(feed).count() == 0


def test_csv_by_name_missing_and_extra_columns(spark, tmp):
    with open(os.path.join(tmp, "forecast_c.csv"), "w") as f:
        f.write("extra,startTime,shortForecast\n")
        f.write("x,2031-03-05T16:00:00Z,Windy\n")
    df = read_csv_by_name(spark, os.path.join(tmp, "forecast_c.csv"), schemas.WEATHER)
    r = df.selectExpr("cast(startTime as timestamp_ntz) s", "endTime", "temperature", "shortForecast").first()
    assert (r.s, r.endTime, r.temperature, r.shortForecast) == (dt.datetime(2031, 3, 5, 16), None, None, "Windy")
    assert df.columns == schemas.WEATHER.fieldNames() + ["ingest_ts"]


def test_summary_mean_skips_nan_and_infinity(spark):
    rows = [("1", "A", T, 10.0, "x"), ("2", "A", T, float("nan"), "x"), ("3", "A", T, float("inf"), "x"),
            ("4", "A", T, 20.0, "x"), ("5", "A", T, None, "x")]
    df = spark.createDataFrame(rows, "entity_id string, routeId string, weather_start timestamp, "
                                     "temperature double, shortForecast string")
    exact = daily_summary(df).first()
    assert exact.entity_id == 5 and exact.temperature == 15.0
    plain = daily_summary(df.where(~F.isnull("temperature") & (F.col("entity_id") != "3"))).first()
    assert plain.temperature == 15.0


def test_compaction_is_spread_over_dates(spark, tmp, monkeypatch):
    """A fact smaller than one file is still rewritten by a task for each date, into few files."""
    monkeypatch.setattr(commits, "TASK_BYTES", 1)
    path = os.path.join(tmp, "fact")
    rows = gold_rows(spark, 40).withColumn("weather_start", F.col("weather_start") + F.make_dt_interval(days=F.col("entity_id").cast("int") % 8))
    for i in range(2):
        sinks.append_new(rows.where(f"entity_id % 2 = {i}"), path, i)
    seen = sorted(map(str, sinks.read_fact(spark, path).collect()))
    assert commits.compact(spark, path) == {"batches": 2, "attempts": 2}
    commits.vacuum(spark, path, keep_seconds=-1)
    files = glob.glob(f"{path}/data/*/*/*.parquet")
    assert len({os.path.basename(f).split("-")[1] for f in files}) > 1  # written by several tasks
    assert len(files) < 16 and sorted(map(str, sinks.read_fact(spark, path).collect())) == seen
