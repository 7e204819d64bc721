"""The polling loop re-expressed as Structured Streaming jobs.

* T1 ``ingest_snapshots``: bronze files -> silver snapshot partitions that the
  gold run reads (``source=live/ingest_ts=...``). The file source keeps track of
  what it has read in the checkpoint. ``ingest`` writes plain Parquet instead.
* T2: with ``dedup_key``, an alert that silver already holds is not written
  again. Known keys are looked up in a ledger beside the snapshots, partitioned by
  start date (``streaming.ledger``), not in watermarked state: ``start`` is a
  service period, so planned work lies days ahead and back-fills lie far behind, and
  no first-seen alert may count as late. A poll reads the dates it touches.
* T3 ``enrich_and_append``: each micro-batch is joined to the nearest weather
  hour (J2) and appended to the fact with the null-safe anti-join (J3). Weather
  is read anew for every micro-batch. Alerts whose hour has not landed wait in
  buckets by day (``streaming.pending``); a later batch, or start of the stream,
  takes up the buckets that new weather reaches and leaves the others unread.
  Keys alone decide what is new and which hour it meets; the texts move through
  one exchange and are written once beside the fact and what waits.

A replayed micro-batch has the same number, so it replaces its own snapshot,
fact batch and pending rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from squall import constants as K
from squall import schemas
from squall.operators.anti_join import anti_join_null_safe
from squall.operators.asof import asof_nearest, candidate_windows
from squall.operators.dedup import distinct_rows, first_per_key
from squall.operators.reshape import rename
from squall.functions.timefn import plus_seconds, utc_date
from squall.plans import gold
from squall.session import shared_dir, shuffles_dropped
from squall.sources import commits, sinks
from squall.sources.snapshots import live_and_latest_history
from squall.streaming.ledger import KeyLedger
from squall.streaming.pending import PendingAlerts, Waiting

INGESTED = "_ingested"


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def read_json_stream(spark: SparkSession, path: str, schema: StructType, multiline: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Bronze JSON files as a stream, with the file's time in ``_ingested``."""
    reader = spark.readStream.schema(schema).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).withColumn(INGESTED, F.col("_metadata.file_modification_time"))


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_path: str,
           checkpoint: str, trigger: str | None = "availableNow",
           partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """T1 into plain Parquet: apply a silver transform to new bronze files."""
    writer = (transform(stream).writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start()


def _snapshot_instant(newest: dt.datetime, batch_id: int) -> dt.datetime:
    """The newest file time of a micro-batch (milliseconds), made distinct
    between batches by microseconds; the same when a batch is replayed."""
    return newest.replace(microsecond=newest.microsecond // 1000 * 1000 + batch_id % 1000)


def ingest_snapshots(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], silver_root: str,
                     checkpoint: str, source: str = K.SOURCE_LIVE, dedup_key: Sequence[str] | None = None,
                     trigger: str | None = "availableNow") -> StreamingQuery:
    """T1 (+T2): every micro-batch of bronze files becomes one silver snapshot.

    ``stream`` comes from ``read_json_stream``; ``transform`` is a silver
    transform. With ``dedup_key`` (for alerts ``K.ALERT_DEDUP_KEY``) only rows
    whose key no other snapshot of ``source`` holds are written, one row per key;
    rows without a ``start`` are dropped as in the batch path (F1).
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max(INGESTED).cast("timestamp_ntz").alias("t")).first()["t"]
        if newest is None:
            return
        taken = _snapshot_instant(newest, batch_id)
        rows = distinct_rows(transform(batch.drop(INGESTED)))
        if not dedup_key:
            sinks.write_snapshot(rows, silver_root, source, taken)
            return
        shared_dir(spark)
        rows = first_per_key(rows.where(F.col("start").isNotNull()), list(dedup_key)).checkpoint(eager=True)
        ledger = KeyLedger(spark, silver_root, source, rows.select(*dedup_key).schema)
        ledger.catch_up()
        known = ledger.known(rows, but=taken)
        if known is not None:
            rows = anti_join_null_safe(rows, known, list(dedup_key))
        sinks.write_snapshot(rows, silver_root, source, taken)
        ledger.record(taken)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def stream_batch_base(checkpoint: str) -> int:
    """Fact batch ids of one stream: a base fixed by its checkpoint location
    (stable across restarts, distinct between streams) plus the micro-batch id,
    so two streams appending to one fact never replace each other's batches."""
    digest = hashlib.sha256(checkpoint.rstrip("/").encode()).digest()
    return (int.from_bytes(digest[:3], "big") + 1) << 38


# micro-batches count up from a stream's base, restarts from the middle of its range
_RETRY_BASE = 1 << 37


def silver_weather(spark: SparkSession, weather_root: str) -> Callable[[], DataFrame]:
    """Prepared weather from the silver snapshots as they are when it is called;
    the same frame again while the snapshot files stay as they are."""
    last: list = [None, None]

    def read() -> DataFrame:
        found = _listing(spark, weather_root)
        if last[0] != found:
            stacked = live_and_latest_history(spark, weather_root, schemas.WEATHER)
            empty = spark.createDataFrame([], schemas.WEATHER)
            last[:] = found, gold.prepare_weather(empty if stacked is None else stacked).checkpoint(eager=True)
        return last[1]
    return read


def _listing(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Files below a folder with their times (names only; nothing is read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getModificationTime()))
    return sorted(out)


def known_alerts(fact: DataFrame, rows: DataFrame, tolerance_seconds: float) -> DataFrame:
    """Alert keys that the fact holds on the dates where ``rows`` may have theirs.

    A match lies within the tolerance of ``start``, and the fact's weather time is
    rounded by half a period more, so an alert's row is on one of few dates (or
    on none, where the weather time is null). Beyond ``MAX_PRUNED_DATES`` dates the
    whole fact is read, with the same result.
    """
    reach = int(tolerance_seconds) + K.FACT_ROUND_SECONDS
    ends = [utc_date(plus_seconds("start", by)) for by in (-reach, reach)]
    dates = [r[0] for r in rows.select(F.explode(F.sequence(*ends)).alias("d")).distinct()
             .limit(sinks.MAX_PRUNED_DATES + 1).collect()]
    if len(dates) <= sinks.MAX_PRUNED_DATES:
        fact = fact.where(F.col("weather_date").isin(dates) | F.col("weather_date").isNull())
    return fact.select(*K.ALERT_DEDUP_KEY)


def enrich_and_append(alerts: DataFrame, weather: DataFrame | Callable[[], DataFrame], fact_path: str, checkpoint: str,
                      tolerance_seconds: float = K.ASOF_TOLERANCE_SECONDS, trigger: str | None = "availableNow",
                      pending_path: str | None = None, expire_after_seconds: float | None = None,
                      on_batch: Callable[[dict], None] | None = None) -> StreamingQuery:
    """Per micro-batch, nearest weather (J2) then idempotent append (J3+S7).

    ``weather`` gives prepared weather (one row per hour): a function is called
    for every micro-batch (``silver_weather``), a DataFrame stays as it is. The
    join's windows are built when the function returns another frame.
    Alerts without an hour within the tolerance wait below ``pending_path``
    (default: beside the checkpoint) in buckets by day. A bucket is tried again
    when the weather hours that reach it have become others, in a later batch or
    when the stream is started. They wait without end, unless
    ``expire_after_seconds`` is set: then alerts of a day that ended this much
    before the newest weather hour are given up and counted.

    An alert key (entity, start, route) that the fact holds is not added again,
    so of a re-polled alert the first version stays, as in the batch run.
    ``on_batch`` receives counts: ``new_rows``, ``pending`` (alerts of this round that
    wait) and ``expired``.
    """
    spark = alerts.sparkSession
    base = stream_batch_base(checkpoint)
    pending = PendingAlerts(spark, pending_path or f"{checkpoint.rstrip('/')}-pending", tolerance_seconds)
    shared_dir(spark)
    fixed = None if callable(weather) else weather.checkpoint(eager=True)
    state: dict = {"hours": None, "windows": None, "reach": None, "newest": None, "checked": None}

    def current() -> None:
        """The weather now, its windows and what it reaches, built when it changes."""
        hours = weather() if fixed is None else fixed
        if hours is not state["hours"]:
            windows = candidate_windows(hours, "startTime", tolerance_seconds)
            state.update(hours=hours, windows=None if windows is None else windows.checkpoint(eager=True),
                         reach=pending.reach(hours).checkpoint(eager=True))
            if expire_after_seconds is not None:
                state["newest"] = hours.agg(F.max(F.unix_micros("startTime"))).first()[0]

    def old_before() -> int | None:
        """Microseconds before which alerts are given up."""
        return None if state["newest"] is None else state["newest"] - int(expire_after_seconds * 1_000_000)

    def due() -> list[Waiting]:
        """Buckets to try again; none while the weather is the one last looked at."""
        current()
        if state["checked"] is state["hours"]:
            return []
        state["checked"] = state["hours"]
        return pending.due(state["reach"], old_before())

    def match(waiting: list[Waiting], batch: DataFrame | None, number: int) -> None:
        current()
        pending.clear()
        parts = ([gold.aligned_alerts(pending.read(waiting))] if waiting else []) + ([batch] if batch is not None else [])
        # what waits came first and stays; then one row per alert key
        parts = [p.withColumn("_late", F.lit(i)) for i, p in enumerate(parts)]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        # all is decided by the keys; the texts are moved once, to the hours of their alerts
        keys = pending.step("keys", rows.select(*K.ALERT_DEDUP_KEY).distinct())
        others = pending.beside(keys, waiting)
        fresh = keys
        if others is not None:
            fresh = anti_join_null_safe(fresh, others.select(*K.ALERT_DEDUP_KEY), list(K.ALERT_DEDUP_KEY))
        fact = sinks.read_fact(spark, fact_path)
        if fact is not None:
            known = known_alerts(fact.where(F.col("batch_id") != F.lit(base + number)), keys, tolerance_seconds)
            fresh = anti_join_null_safe(fresh, known, list(K.ALERT_DEDUP_KEY))
        hours = asof_nearest(pending.step("fresh", fresh), state["hours"], "start", "startTime", tolerance_seconds, how="left",
                             right_unique=True, windows=state["windows"])
        hours = pending.step("hours", rename(hours, {"startTime": "weather_start", "endTime": "weather_end"}))
        rows = first_per_key(rows, K.ALERT_DEDUP_KEY, order=["_late", *gold.STACK_ORDER], beside=hours,
                             ranged=["start", "entity_id", "routeId"])
        joined = pending.step("rows", rows.select(*schemas.GOLD.fieldNames()))
        out = sinks.append_new(joined.where(F.col("weather_start").isNotNull()), fact_path, base + number, materialized=True,
                               clustered=True)
        left = joined.where(F.col("weather_start").isNull()).select(*K.ALERT_COLUMNS)
        out["expired"] = 0
        if old_before() is not None:
            old = F.unix_micros("start") < F.lit(old_before())
            out["expired"] = left.where(old).count()
            left = left.where(~old)
        out["pending"] = pending.write(left, number, state["reach"])
        pending.clear()
        if on_batch:
            on_batch(out)

    def retry() -> None:
        """Try what waits before the first batch: first a try that was cut off."""
        for number in [n for n in pending.rounds() if n >= _RETRY_BASE]:
            pending.remove_round(number)
            if pending.taken(number):
                match(pending.taken(number), None, number)
            pending.settle(number)
        taken = due()
        if taken:
            number = _RETRY_BASE + int(time.time())
            while commits.holds(spark, fact_path, base + number):
                number += 1
            pending.take(number, taken)
            match(taken, None, number)
            pending.settle(number)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        for number in pending.rounds():
            if number < batch_id:  # committed: it cannot be replayed
                pending.settle(number)
        pending.remove_round(batch_id)  # of a try that was cut off
        if batch_id not in pending.rounds():
            pending.take(batch_id, due())
        match(pending.taken(batch_id), gold.aligned_alerts(batch), batch_id)

    def tidily(batch: DataFrame, batch_id: int) -> None:
        with shuffles_dropped(spark, batch.sparkSession):
            per_batch(batch, batch_id)

    with shuffles_dropped(spark):
        retry()
    writer = alerts.writeStream.foreachBatch(tidily).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()
    return query
