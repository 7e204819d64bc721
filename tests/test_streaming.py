"""T1–T3 on small files: the streaming result equals the batch result."""

import datetime as dt
import glob
import json
import os
import re
import time

from pyspark.sql import functions as F

from squall import constants as K
from squall import schemas
from squall.operators.dedup import first_per_key
from squall.plans import gold, silver
from squall.sources import bronze, sinks
from squall.sources.snapshots import live_and_latest_history
from squall.streaming import incremental as T

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def records(n, offset=0):
    return [{"status_id": str(i), "date": (T0 + dt.timedelta(minutes=10 * i)).isoformat(),
             "affected": "A | B" if i % 2 else None, "header": "Snow", "agency": "Subway"}
            for i in range(offset, offset + n)]


def write_lines(path, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))


def snapshots(spark, root):
    return spark.read.schema(schemas.ALERT).parquet(root).select(*schemas.ALERT.fieldNames())


def poll_stream(spark, src, root, ck):
    stream = T.read_json_stream(spark, src, schemas.HISTORICAL_ALERT_RECORD, max_files_per_trigger=1)
    T.run_to_end(T.ingest_snapshots(stream, silver.historical_alert_rows, root, ck, dedup_key=K.ALERT_DEDUP_KEY))


def test_ingest_and_dedup_equal_batch(spark, tmp):
    src, root, ck = (os.path.join(tmp, x) for x in ("bronze", "silver", "_ck"))
    write_lines(os.path.join(src, "poll1.json"), records(20))
    write_lines(os.path.join(src, "poll2.json"), records(20, offset=10))  # 10 repeated alerts
    poll_stream(spark, src, root, ck)
    got = snapshots(spark, root)
    batch = silver.historical_alerts(bronze.read_json(spark, src, schemas.HISTORICAL_ALERT_RECORD, multiline=False))
    assert got.count() == batch.count() == 45
    assert sorted(got.collect()) == sorted(batch.drop("ingest_ts").collect())
    poll_stream(spark, src, root, ck)  # a re-run from the same checkpoint adds nothing
    assert snapshots(spark, root).count() == 45
    # the snapshots are those that the gold run reads
    assert live_and_latest_history(spark, root, schemas.ALERT).count() == 45


def test_no_first_seen_alert_is_late(spark, tmp):
    """Six alerts over five polls; the second poll plans work 14 days ahead."""
    src, root, ck = (os.path.join(tmp, x) for x in ("bronze", "silver", "_ck"))
    starts = [T0, T0 + dt.timedelta(days=14), T0 + dt.timedelta(hours=1), T0 - dt.timedelta(days=30), T0, T0]
    polls = [[0], [0, 1], [1, 2], [3], [4, 5, 0]]
    for n, ids in enumerate(polls):
        write_lines(os.path.join(src, f"poll{n}.json"), [
            {"status_id": str(i), "date": starts[i].isoformat(), "affected": "A", "header": f"h{i}", "agency": "Subway"}
            for i in ids])
        poll_stream(spark, src, root, ck)
    assert sorted(r.entity_id for r in snapshots(spark, root).collect()) == list("012345")


def test_files_of_one_time_do_not_replace_each_other(spark, tmp):
    src, root, ck = (os.path.join(tmp, x) for x in ("bronze", "silver", "_ck"))
    for n in range(4):
        write_lines(os.path.join(src, f"poll{n}.json"), records(2, offset=10 * n))
        os.utime(os.path.join(src, f"poll{n}.json"), (1_700_000_000, 1_700_000_000))
    poll_stream(spark, src, root, ck)
    assert snapshots(spark, root).select("entity_id").distinct().count() == 8


def _alert(i, start, header="Snow"):
    return (str(i), "A", start, None, header, None)


def _enrich(spark, tmp, counts=None, **kw):
    stream = T.read_parquet_stream(spark, os.path.join(tmp, "alerts", "*"), schemas.ALERT, max_files_per_trigger=1)
    T.run_to_end(T.enrich_and_append(stream, T.silver_weather(spark, os.path.join(tmp, "weather")), os.path.join(tmp, "fact"),
                                     os.path.join(tmp, "_ck"), on_batch=counts.append if counts is not None else None, **kw))
    return sorted((r.entity_id, r.header_text) for r in sinks.read_fact(spark, os.path.join(tmp, "fact")).collect())


def _land(spark, tmp, name, rows):
    spark.createDataFrame(rows, schemas.ALERT).coalesce(1).write.parquet(os.path.join(tmp, "alerts", name))


def _hour(spark, tmp, n, start):
    wx = spark.createDataFrame([(start, start + dt.timedelta(hours=1), 30.0, "Snow")], schemas.WEATHER)
    sinks.write_snapshot(wx, os.path.join(tmp, "weather"), "live", dt.datetime(2024, 1, 1) + dt.timedelta(hours=n))


def test_alerts_wait_for_their_weather_hour(spark, tmp):
    day = dt.timedelta(days=1)
    counts = []
    _hour(spark, tmp, 0, T0)
    _land(spark, tmp, "p0", [_alert(1, T0), _alert(2, T0 + day), _alert(3, T0 + 2 * day)])
    assert _enrich(spark, tmp, counts) == [("1", "Snow")]
    assert counts[-1] == {"new_rows": 1, "expired": 0, "pending": 2}
    _hour(spark, tmp, 1, T0 + day)
    assert _enrich(spark, tmp, counts) == [("1", "Snow"), ("2", "Snow")]      # a restart without new alerts
    assert _enrich(spark, tmp, counts) == [("1", "Snow"), ("2", "Snow")]
    _hour(spark, tmp, 2, T0 + 2 * day)
    _land(spark, tmp, "p1", [_alert(4, T0), _alert(1, T0, "changed")])
    assert _enrich(spark, tmp, counts) == [("1", "Snow"), ("2", "Snow"), ("3", "Snow"), ("4", "Snow")]
    assert counts[-1]["pending"] == 0
    batch = gold.combine(gold.prepare_alerts(spark.read.parquet(os.path.join(tmp, "alerts", "*"))),
                         T.silver_weather(spark, os.path.join(tmp, "weather"))())
    assert batch.count() == 4


def test_waiting_alerts_can_expire(spark, tmp):
    counts = []
    _hour(spark, tmp, 0, T0)
    _land(spark, tmp, "p0", [_alert(1, T0 - dt.timedelta(days=9)), _alert(2, T0 + dt.timedelta(days=1))])
    assert _enrich(spark, tmp, counts, expire_after_seconds=3 * 86400) == []
    assert counts == [{"new_rows": 0, "expired": 1, "pending": 1}]


def test_first_version_of_an_alert_stays(spark, tmp):
    _hour(spark, tmp, 0, T0)
    for n, header in enumerate(["first", "second", "third"]):
        _land(spark, tmp, f"p{n}", [_alert(7, T0, header)])
        assert _enrich(spark, tmp) == [("7", "first")]


def test_enrich_and_append_equals_batch(spark, tmp):
    alerts = spark.createDataFrame(
        [(str(i), "A", T0 + dt.timedelta(minutes=37 * i), None, "Snow", None) for i in range(12)], schemas.ALERT)
    src = os.path.join(tmp, "silver_alerts")
    alerts.write.parquet(src)
    wx = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=h), T0 + dt.timedelta(hours=h + 1), 30.0 + h, "Snow") for h in range(0, 8, 3)],
        schemas.WEATHER)
    fact = os.path.join(tmp, "fact")
    q = T.enrich_and_append(T.read_parquet_stream(spark, src, schemas.ALERT), wx, fact, os.path.join(tmp, "_ck"))
    T.run_to_end(q)
    streamed = sinks.read_fact(spark, fact).drop("batch_id")
    batch = sinks.fact_rows(gold.combine(alerts, wx), 0).drop("batch_id")
    assert sorted(streamed.collect()) == sorted(batch.select(*streamed.columns).collect())


def test_processing_time_trigger_picks_up_new_files(spark, tmp):
    src = os.path.join(tmp, "bronze")
    write_lines(os.path.join(src, "poll1.json"), records(5))
    out = os.path.join(tmp, "silver")
    stream = T.read_json_stream(spark, src, schemas.HISTORICAL_ALERT_RECORD)
    q = T.ingest(stream, silver.historical_alert_rows, os.path.join(out, "data"), os.path.join(out, "_ck"),
                 trigger="1 second")
    try:
        q.processAllAvailable()
        write_lines(os.path.join(src, "poll2.json"), records(3, offset=100))
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(os.path.join(out, "data")).select("entity_id").distinct().count() == 8


def test_live_feed_documents_stream(spark, tmp):
    src = os.path.join(tmp, "bronze_feed")
    os.makedirs(src)
    for n in range(3):
        doc = {"entity": [{"id": f"a{n}", "alert": {
            "headerText": {"translation": [{"text": "[Q] snow"}]},
            "informedEntity": [{"routeId": None}, {"routeId": "N"}],
            "activePeriod": [{"start": str(1700000000 + 60 * n)}]}}]}
        with open(os.path.join(src, f"alerts_feed_{n}.json"), "w") as f:
            json.dump(doc, f, indent=2)  # multi-line documents
    out = os.path.join(tmp, "silver_feed")
    stream = T.read_json_stream(spark, src, schemas.LIVE_ALERT_FEED, multiline=True)
    T.run_to_end(T.ingest(stream, silver.live_alert_rows, os.path.join(out, "data"), os.path.join(out, "_ck")))
    got = sorted((r.entity_id, r.routeId) for r in spark.read.parquet(os.path.join(out, "data")).collect())
    assert got == [(f"a{n}", r) for n in range(3) for r in ("N", "Q")]


def test_stream_batch_bases_are_stable_and_distinct():
    a = T.stream_batch_base("/shared/ckpt/stream-a")
    assert a == T.stream_batch_base("/shared/ckpt/stream-a/")
    assert a != T.stream_batch_base("/shared/ckpt/stream-b")
    assert a % (1 << 38) == 0 and a + (1 << 38) < 1 << 63  # room for every micro-batch and restart


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_reads_the_dates_of_the_poll_only(spark, tmp):
    root = os.path.join(tmp, "silver", "alerts")
    day = dt.timedelta(days=1)
    for n in range(4):
        rows = spark.createDataFrame([_alert(f"{n}-{i}", T0 + i * day) for i in range(5)], schemas.ALERT)
        sinks.write_snapshot(rows, root, "live", T0 + dt.timedelta(hours=n, microseconds=1000 * n))
    sinks.write_snapshot(spark.createDataFrame([_alert("h", T0)], schemas.ALERT), root, "historical", T0)
    key = spark.createDataFrame([], schemas.ALERT).select(*K.ALERT_DEDUP_KEY).schema
    ledger = T.KeyLedger(spark, root, "live", key)
    batch = spark.createDataFrame([_alert("new", T0 + day), _alert("0-1", T0 + day), _alert("far", T0 + 400 * day)], schemas.ALERT)
    assert ledger.known(batch, but=T0) is None
    assert len(ledger.catch_up()) == 4 and ledger.catch_up() == []   # snapshots from elsewhere are found once
    known = ledger.known(batch, but=T0)                                # T0 is the first snapshot: a replay does not know itself
    assert sorted(r.entity_id for r in known.collect()) == ["1-1", "2-1", "3-1"]
    assert all("start_date=2024-01-02" in f for f in known.inputFiles())
    assert re.search(r"PartitionFilters: \[[^\]]*start_date", _plan(known)), _plan(known)
    assert ledger.known(spark.createDataFrame([_alert("far", T0 + 400 * day)], schemas.ALERT), but=T0) is None
    # beyond the bound the whole ledger is read, with the same result
    import squall.streaming.ledger as L
    bound, L.MAX_PRUNED_DATES = L.MAX_PRUNED_DATES, 0
    try:
        whole = ledger.known(batch, but=T0)
        assert whole.count() == 15 and sorted(r.entity_id for r in whole.where("start = '2024-01-02 12:00:00'").collect()) == ["1-1", "2-1", "3-1"]
    finally:
        L.MAX_PRUNED_DATES = bound
    # the ledger is no snapshot
    assert live_and_latest_history(spark, root, schemas.ALERT).count() == 21


def test_replayed_poll_keeps_its_alerts(spark, tmp, monkeypatch):
    """Cut off between snapshot and ledger, and again after the ledger."""
    src, root, ck = (os.path.join(tmp, x) for x in ("bronze", "silver", "_ck"))
    write_lines(os.path.join(src, "poll1.json"), records(6))
    record = T.KeyLedger.record
    for late in (False, True):
        def cut(self, taken, late=late):
            if late:
                record(self, taken)
            raise RuntimeError("cut off")
        monkeypatch.setattr(T.KeyLedger, "record", cut)
        try:
            poll_stream(spark, src, root, ck)
        except Exception:  # noqa: BLE001 - the stream wraps it
            pass
    monkeypatch.setattr(T.KeyLedger, "record", record)
    poll_stream(spark, src, root, ck)
    assert snapshots(spark, root).count() == 9
    write_lines(os.path.join(src, "poll2.json"), records(8))
    poll_stream(spark, src, root, ck)
    assert snapshots(spark, root).count() == snapshots(spark, root).distinct().count() == 12


def _reads(monkeypatch):
    seen, read = [], T.PendingAlerts.read

    def spy(self, folders):
        seen.extend(folders)
        return read(self, folders)
    monkeypatch.setattr(T.PendingAlerts, "read", spy)
    return seen


def test_waiting_buckets_stay_unread_without_new_weather(spark, tmp, monkeypatch):
    day, counts = dt.timedelta(days=1), []
    _hour(spark, tmp, 0, T0)
    _land(spark, tmp, "p0", [_alert(1, T0), *(_alert(10 + i, T0 + (i + 1) * day) for i in range(4))])
    _enrich(spark, tmp, counts)
    assert counts[-1]["pending"] == 4
    seen = _reads(monkeypatch)
    _land(spark, tmp, "p1", [_alert(2, T0), _alert(11, T0 + 2 * day, "changed"), _alert(20, T0 + 9 * day)])
    _enrich(spark, tmp, counts)
    # no new weather: only the bucket of an alert in the batch is read, for its keys
    assert counts[-1] == {"new_rows": 1, "expired": 0, "pending": 1} and {f.bucket for f in seen} == {
        int((T0 + 2 * day).replace(tzinfo=dt.timezone.utc).timestamp()) // (24 * 3600)}
    seen.clear()
    _hour(spark, tmp, 1, T0 + 2 * day)
    assert ("11", "Snow") in _enrich(spark, tmp, counts)       # the first version stays
    assert len({f.bucket for f in seen}) == 1 and counts[-1] == {"new_rows": 1, "expired": 0, "pending": 0}
    for n, i in enumerate((0, 2, 3, 8)):
        _hour(spark, tmp, 2 + n, T0 + (i + 1) * day)
    assert [e for e, _ in _enrich(spark, tmp, counts)] == ["1", "10", "11", "12", "13", "2", "20"]
    root = os.path.join(tmp, "_ck-pending")
    assert not any(n.startswith("bucket=") for n in os.listdir(root))


def test_replay_of_a_batch_that_took_up_waiting_alerts(spark, tmp):
    """Cut off after the fact was written: what waited is neither lost nor doubled."""
    day, counts = dt.timedelta(days=1), []
    wx = os.path.join(tmp, "weather")
    _hour(spark, tmp, 0, T0)
    _land(spark, tmp, "p0", [_alert(1, T0), _alert(2, T0 + day), _alert(3, T0 + 2 * day)])
    _enrich(spark, tmp, counts)
    _land(spark, tmp, "p1", [_alert(4, T0 + day), _alert(5, T0 + 3 * day)])

    class Late:
        """Weather that lands between the start of the stream and its first batch."""
        calls, read = 0, T.silver_weather(spark, wx)

        def __call__(self):
            self.calls += 1
            if self.calls == 2:
                _hour(spark, tmp, 1, T0 + day)
            return Late.read()

    def cut(out):
        counts.append(out)
        raise RuntimeError("cut off")

    for weather, then in ((Late(), cut), (T.silver_weather(spark, wx), cut), (T.silver_weather(spark, wx), counts.append)):
        stream = T.read_parquet_stream(spark, os.path.join(tmp, "alerts", "*"), schemas.ALERT, max_files_per_trigger=1)
        try:
            T.run_to_end(T.enrich_and_append(stream, weather, os.path.join(tmp, "fact"), os.path.join(tmp, "_ck"), on_batch=then))
        except Exception:  # noqa: BLE001
            pass
        got = sorted(r.entity_id for r in sinks.read_fact(spark, os.path.join(tmp, "fact")).collect())
        assert got == ["1", "2", "4"]
    for n in (2, 3):
        _hour(spark, tmp, n, T0 + n * day)
    assert [e for e, _ in _enrich(spark, tmp)] == ["1", "2", "3", "4", "5"]


def test_known_alerts_prune_the_fact(spark, tmp):
    path = os.path.join(tmp, "fact")
    day = dt.timedelta(days=1)
    alerts = spark.createDataFrame([_alert(i, T0 + i * day) for i in range(6)], schemas.ALERT)
    late = dt.datetime(2024, 1, 3, 23, 58)  # weather of the next day, and rounded into it
    alerts = alerts.union(spark.createDataFrame([_alert("m", late)], schemas.ALERT))
    wx = spark.createDataFrame([(T0 + i * day, None, 1.0, "Snow") for i in range(6)] + [(late, None, 1.0, "Snow")], schemas.WEATHER)
    sinks.append_new(gold.combine(alerts, wx), path, 1)
    none = gold.combine(alerts.limit(1), wx).withColumn("weather_start", F.lit(None).cast("timestamp"))
    sinks.append_new(none.withColumn("entity_id", F.lit("n")), path, 2)
    batch = spark.createDataFrame([_alert(2, T0 + 2 * day), _alert("m", late)], schemas.ALERT)
    known = T.known_alerts(sinks.read_fact(spark, path), batch, K.ASOF_TOLERANCE_SECONDS)
    assert {r.entity_id for r in known.collect()} >= {"2", "m", "n"}  # and whatever else these dates hold
    assert not {r.entity_id for r in known.collect()} & {"0", "1", "4", "5"}
    assert re.search(r"PartitionFilters: \[[^\]]*weather_date", _plan(known)), _plan(known)


def test_a_poll_is_one_micro_batch_of_files_from_many_tasks(spark, tmp, monkeypatch):
    """Polls are written by as many tasks as their events are read by, and still taken one by one."""
    from squall.plans import standins
    read = standins._read
    monkeypatch.setattr(standins, "_read", lambda s, d, name, *a: read(s, d, name, *a).repartition(3))
    monkeypatch.setattr("squall.session.fresh_dir", lambda s, prefix: f"{tmp}/{prefix}")
    standins._stream_polls(spark, "/root/testdata/sf0.001", f"{tmp}/alerts", f"{tmp}/check")
    for poll in range(standins.POLLS):
        assert len(glob.glob(f"{tmp}/bronze-polls/poll={poll}/*.json")) == 3
    rows = spark.read.parquet(f"{tmp}/alerts")
    assert {n for n in os.listdir(f"{tmp}/check/commits") if n[0] != "."} == {str(i) for i in range(standins.POLLS)}
    assert rows.select("ingest_ts").distinct().count() == standins.POLLS - 1  # the last poll holds nothing new
    assert 0 < rows.count() == rows.select(*K.ALERT_DEDUP_KEY).distinct().count()


def _bytes(*folders):
    return sum(os.path.getsize(p) for top in folders for p in glob.glob(f"{top}/**", recursive=True) if os.path.isfile(p))


def test_enriched_texts_leave_no_copies_behind(spark, tmp):
    """Neither checkpoints nor shuffle files hold the texts once a batch is over."""
    texts = [os.urandom(20_000).hex() for _ in range(100)]
    rows = [(str(i), "A", T0 + dt.timedelta(days=i % 2, seconds=i), None, "Snow", t) for i, t in enumerate(texts)]
    size = sum(map(len, texts))
    jvm = spark.sparkContext._jvm
    local = [f.getPath() for f in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    kept = [spark.sparkContext.getCheckpointDir().removeprefix("file:")]
    jvm.System.gc()
    time.sleep(2)  # the cleaner's turn
    shuffled, checkpointed = _bytes(*local), _bytes(*kept)
    _hour(spark, tmp, 0, T0)
    _land(spark, tmp, "p0", rows)
    assert len(_enrich(spark, tmp)) == 50
    _hour(spark, tmp, 1, T0 + dt.timedelta(days=1))
    assert len(_enrich(spark, tmp)) == 100
    fact = sinks.read_fact(spark, os.path.join(tmp, "fact"))
    assert sorted(r[0] for r in fact.select("description_text").collect()) == sorted(texts)
    assert _bytes(*kept) - checkpointed < size / 4
    for _ in range(40):  # executors drop them in their own time
        if _bytes(*local) - shuffled < size / 4:
            break
        time.sleep(0.25)
    assert _bytes(*local) - shuffled < size / 4
    assert not os.path.exists(os.path.join(tmp, "_ck-pending", "_work"))


def test_first_rows_meet_what_lies_beside_in_one_exchange(spark, tmp):
    rows = spark.createDataFrame([("1", "A", T0, None, "b", None), ("1", "A", T0, None, "a", "x"), ("1", None, T0, None, "n", None),
                                  (None, "A", T0, None, "z", None), ("2", "A", T0, None, "gone", None)], schemas.ALERT)
    beside = spark.createDataFrame([("1", "A", T0, 1.0), ("1", None, T0, None), (None, "A", T0, 3.0), ("9", "A", T0, 9.0)],
                                   "entity_id string, routeId string, start timestamp, temperature double")
    rows.write.parquet(f"{tmp}/rows")
    beside.write.parquet(f"{tmp}/beside")
    out = first_per_key(spark.read.parquet(f"{tmp}/rows"), K.ALERT_DEDUP_KEY, beside=spark.read.parquet(f"{tmp}/beside"),
                        ranged=["start", "entity_id", "routeId"])
    got = {(r.entity_id, r.routeId): (r.header_text, r.description_text, r.temperature) for r in out.collect()}
    assert got == {("1", "A"): ("a", "x", 1.0), ("1", None): ("n", None, None), (None, "A"): ("z", None, 3.0)}
    assert out.count() == 3 and out.columns == [*schemas.ALERT.fieldNames(), "temperature"]
    assert _plan(out).split("Initial Plan")[-1].count("Exchange ") == 1, _plan(out)


def test_clustered_rows_meet_the_fact_as_others_do(spark, tmp, monkeypatch):
    """Alerts of one weather hour and header, in two batches: J3 drops them however it is planned."""
    def gold_rows(ids):
        alerts = spark.createDataFrame([(e, r, T0 + dt.timedelta(seconds=s), None, h, None) for e, r, s, h in ids], schemas.ALERT)
        wx = spark.createDataFrame([(T0, None, 1.0, "Snow")], schemas.WEATHER)
        return gold.combine(alerts, wx)
    held = [("1", "A", 0, "h"), ("2", None, 0, "h"), ("3", "A", 0, None)]
    new = [("1", "A", 5, "h"), ("1", "A", 6, "i"), ("2", None, 5, "h"), ("3", "A", 5, None), ("4", "A", 0, "h"), ("4", "A", 1, "h")]
    gold_rows(new).write.parquet(f"{tmp}/new")
    left = []
    for n, (clustered, most) in enumerate(((False, 0), (True, 10), (True, 0))):
        monkeypatch.setattr(sinks, "BROADCAST_KEYS", most)
        path = f"{tmp}/fact{n}"
        sinks.append_new(gold_rows(held), path, 1)
        rows = spark.read.parquet(f"{tmp}/new")
        assert sinks.append_new(rows, path, 2, materialized=True, clustered=clustered) == {"new_rows": 3}
        left.append(sorted((r.entity_id, r.start, r.header_text) for r in sinks.read_fact(spark, path).where("batch_id = 2").collect()))
    assert left[0] == left[1] == left[2] and [x[0] for x in left[0]] == ["1", "4", "4"]
