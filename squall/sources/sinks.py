"""S6–S10 sinks: silver snapshots, the idempotent fact append, summary, view, export."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from squall import constants as K
from squall import schemas
from squall.functions.text import null_to_empty
from squall.functions.timefn import round_to, utc_date
from squall.operators.anti_join import anti_join_null_safe, null_safe_key
from squall.session import shared_dir
from squall.sources import commits

# The fact is pruned to the dates a new batch touches when there are at most
# this many of them; beyond that the anti-join reads all of the fact.
MAX_PRUNED_DATES = 10_000

# Keys that the fact holds already may be broadcast to clustered rows up to this
# many and as many bytes (counted).
BROADCAST_KEYS, BROADCAST_KEY_BYTES = 100_000, 16 << 20


def write_snapshot(df: DataFrame, root: str, source: str, ingest_ts: dt.datetime) -> dict:
    """S6 + A9: one new snapshot partition per run; a re-run of the same
    snapshot replaces only its own partition (dynamic partition overwrite).

    Returns ``{"rows": n}`` (rows parsed into the snapshot) from an
    ``Observation`` on the write itself.
    """
    obs = Observation(f"snapshot_{source}_{ingest_ts:%Y%m%d%H%M%S}")
    (df.withColumn("source", F.lit(source))
       .withColumn("ingest_ts", F.lit(ingest_ts).cast("timestamp"))
       .observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("source", "ingest_ts").parquet(root))
    return {"rows": int(obs.get.get("rows", 0) or 0)}


def read_fact(spark, fact_path: str) -> DataFrame | None:
    """The fact table, or ``None`` only when it does not exist yet."""
    return commits.read(spark, fact_path)


def fact_rows(gold: DataFrame, batch_id: int) -> DataFrame:
    """E6 + partition columns: weather_start rounded to 15 minutes (ties to even)."""
    return (gold.withColumn("weather_start", round_to("weather_start", K.FACT_ROUND_SECONDS))
                .withColumn("weather_date", utc_date("weather_start"))
                .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))


def append_new(gold: DataFrame, fact_path: str, batch_id: int, key=K.FACT_KEY,
               materialized: bool = False, clustered: bool = False) -> dict:
    """J3 + S7 + A9: append the gold rows whose key is not yet in the fact.

    * The new rows are checkpointed first (shared checkpoint folder) unless the
      caller already did: lineage is cut, an executor loss cannot change them,
      and they are computed once for the date list, the range sample, the
      anti-join and the write.
    * The existing fact is read with only the key columns, pruned to the dates
      the batch touches (the key contains weather_start, so equal keys share a
      date, and null dates meet null dates) and to the *other* batches, then
      null-safe anti-joined. Beyond ``MAX_PRUNED_DATES`` dates it is read
      unpruned, with the same result.
    * The rows go to a folder of their own, which one commit makes the holder of
      the batch: a retried batch replaces itself as a whole, whatever dates it
      held before, and readers see it as it was until then. One writer at a time
      appends (two at once might add the same key).

    ``materialized=True`` tells it ``gold`` is already materialised by the caller,
    ``clustered=True`` also that it is Parquet in ranges of time: the keys that meet
    are looked for first (only key columns are read), and unless they are many the
    rows are written as they lie, without an exchange.
    Returns ``{"new_rows": n}`` collected through an ``Observation`` (no extra job).
    """
    spark = gold.sparkSession
    rows = fact_rows(gold, batch_id).select(*schemas.FACT.fieldNames())
    if not materialized:
        shared_dir(spark)
        rows = rows.checkpoint(eager=True)
    existing = read_fact(spark, fact_path)
    if existing is not None:
        existing = existing.where(F.col("batch_id") != F.lit(int(batch_id)))
        dates = [r[0] for r in rows.select("weather_date").distinct().limit(MAX_PRUNED_DATES + 1).collect()]
        if len(dates) <= MAX_PRUNED_DATES:
            touched = F.col("weather_date").isin([d for d in dates if d is not None])
            existing = existing.where(touched | F.col("weather_date").isNull() if None in dates else touched)
        existing = existing.select(*key)
        if clustered:
            existing, clustered = _few_met(rows, existing, list(key))
        rows = anti_join_null_safe(rows, existing, key) if existing is not None else rows
    obs = Observation(f"fact_append_{batch_id}")
    # range-cluster by date before the partitioned write: each task covers a
    # contiguous span of dates (files ~ tasks + dates, not tasks x dates) and a
    # date holding a large share of the rows is split over several tasks
    rows = rows if clustered else rows.repartitionByRange(*commits.ORDER)
    rows = rows.observe(obs, F.count(F.lit(1)).alias("new_rows"))
    attempt = commits.new_attempt()
    commits.write_attempt(rows, fact_path, attempt)
    commits.publish(spark, fact_path, attempt, [int(batch_id)])
    got = obs.get
    return {"new_rows": int(got.get("new_rows", 0) or 0)}


def _few_met(rows: DataFrame, existing: DataFrame, key: list[str]) -> tuple[DataFrame | None, bool]:
    """The keys of ``existing`` that ``rows`` have too, marked for a broadcast
    (None if there are none) and True; ``existing`` and False if they are many."""
    shared_dir(rows.sparkSession)
    ours, names = null_safe_key(rows.select(*key), key)
    theirs, _ = null_safe_key(existing, key)
    met = theirs.join(ours.select(*names).distinct(), names, "left_semi").select(*key).distinct().checkpoint(eager=True)
    wide = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in key), F.lit(0))
    size = met.agg(F.count(F.lit(1)).alias("n"), F.sum(wide.cast("long")).alias("b")).first()
    if size["n"] > BROADCAST_KEYS or (size["b"] or 0) > BROADCAST_KEY_BYTES:
        return met, False
    return (F.broadcast(met) if size["n"] else None), True


def write_summary(summary: DataFrame, path: str) -> bool:
    """Replace the summary; nothing is written when it is empty.

    The summary is an aggregate (one row per day and route); it is kept in
    memory/disk between the emptiness check and the write.
    """
    summary = summary.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if summary.isEmpty():
            return False
        summary.write.mode("overwrite").parquet(path)
        return True
    finally:
        summary.unpersist()


def register_view(df: DataFrame, name: str = K.IMPACT_VIEW_NAME) -> DataFrame:
    """S9 for this session: (re)define the reporting view as a temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_contains(column: str, keywords) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), {_sql_text(k.lower())})" for k in keywords) + ")"


def impact_view_sql(fact_path: str) -> str:
    """The reporting view over the fact files as one SQL query."""
    cases = " ".join(f"WHEN {_sql_contains('shortForecast', kws)} THEN {_sql_text(label)}"
                     for kws, label in K.FORECAST_CATEGORY_RULES)
    return (f"SELECT routeId, weather_start, CASE {cases} ELSE {_sql_text(K.FORECAST_CATEGORY_DEFAULT)} END "
            f"AS weather_category, count(DISTINCT entity_id) AS total_alerts FROM {commits.live_sql(fact_path)} "
            f"WHERE {_sql_contains('header_text', K.HEADER_WEATHER_KEYWORDS)} "
            f"OR {_sql_contains('description_text', K.DESCRIPTION_WEATHER_KEYWORDS)} GROUP BY ALL")


def create_view(spark, fact_path: str, name: str = K.IMPACT_VIEW_NAME) -> DataFrame:
    """S9 in the catalog: (re)define the reporting view over the fact files, so
    other sessions can query it and always see the current fact. With a
    persistent catalog (Hive support) it outlives the job; the in-memory
    catalog keeps it for the application. The fact must hold a file."""
    spark.catalog.dropTempView(name)  # it would hide the catalog's view
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {impact_view_sql(fact_path)}")
    return spark.table(name)


def export_rows(view: DataFrame, order=("routeId", "weather_start", "weather_category")) -> DataFrame:
    """E17 + O1: every column as text, null -> '', in report order.

    Timestamps keep their UTC offset (``2013-03-01 05:00:00+00:00``).
    """
    cols = []
    for f in view.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ssxxx")  # wall clock read as UTC
        cols.append(null_to_empty(c).alias(f.name))
    return view.orderBy(*[F.col(c).asc_nulls_first() for c in order if c in view.columns]).select(*cols)


def export_csv(view: DataFrame, path: str) -> bool:
    """Write the view as CSV with a header; skipped when empty.

    The sort is a distributed range sort; part files are in report order.
    """
    view = view.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if view.isEmpty():
            return False
        export_rows(view).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
        return True
    finally:
        view.unpersist()
