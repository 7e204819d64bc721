"""Silver -> gold: stack, dedup, nearest weather, summary, fact, view, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from squall import constants as K
from squall import schemas
from squall.functions.text import blank_to_null
from squall.functions.timefn import lenient_timestamp
from squall.operators.aggregates import daily_summary, impact_aggregate
from squall.operators.asof import asof_nearest
from squall.operators.dedup import first_per_key
from squall.operators.reshape import rename
from squall.sources import sinks
from squall.session import fresh_dir, remove_dir, shared_dir
from squall.sources.snapshots import live_and_latest_history


def _source_rank() -> F.Column:
    return F.when(F.col("source") == K.SOURCE_HISTORICAL, 0).otherwise(1)


def _with_tags(df: DataFrame) -> DataFrame:
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit(K.SOURCE_LIVE))
    if "ingest_ts" not in df.columns:
        df = df.withColumn("ingest_ts", F.lit(None).cast("timestamp"))
    return df


def _time(df: DataFrame, c: str) -> F.Column:
    """E1 unless the column already holds instants."""
    if c not in df.columns:
        return F.lit(None).cast("timestamp").alias(c)
    if df.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        return F.col(c).cast("timestamp").alias(c)
    return lenient_timestamp(F.col(c)).alias(c)


def _text(df: DataFrame, c: str) -> F.Column:
    if c not in df.columns:
        return F.lit(None).cast("string").alias(c)
    return blank_to_null(F.col(c).cast("string")).alias(c)


# stack order: history before live, older snapshot first
STACK_ORDER = ("_rank", "_ingest")


def aligned_alerts(stacked: DataFrame) -> DataFrame:
    """Align (P9/P8), parse (E1), drop null start (F1); with ``STACK_ORDER``.

    Empty text is null, as after a text-file (CSV) round trip.
    """
    df = _with_tags(stacked)
    df = df.select(*[_time(df, c) if c in ("start", "end") else _text(df, c) for c in K.ALERT_COLUMNS],
                   _source_rank().alias("_rank"), F.col("ingest_ts").alias("_ingest"))
    return df.where(F.col("start").isNotNull())


def prepare_alerts(stacked: DataFrame) -> DataFrame:
    """``aligned_alerts``, one row per (entity_id, start, routeId) keeping the
    first in stack order (A7). The key compares parsed instants, not their text.
    """
    return first_per_key(aligned_alerts(stacked), K.ALERT_DEDUP_KEY, order=STACK_ORDER).select(*K.ALERT_COLUMNS)


def prepare_weather(stacked: DataFrame) -> DataFrame:
    """Parse (E1), drop null startTime (F1), one row per hour: live over
    history, then the newest snapshot (duplicate weather hours)."""
    df = _with_tags(stacked)
    if "temperature" not in df.columns:
        temp = F.lit(None).cast("double")
    elif isinstance(df.schema["temperature"].dataType, NumericType):
        temp = F.col("temperature").cast("double")
    else:  # text (e.g. a CSV snapshot): coerce, junk -> null
        temp = F.col("temperature").cast("string").try_cast("double")
    df = df.select(_time(df, "startTime"), _time(df, "endTime"), temp.alias("temperature"),
                   _text(df, "shortForecast"), _source_rank().alias("_rank"), F.col("ingest_ts").alias("_ingest"))
    df = df.where(F.col("startTime").isNotNull())
    df = first_per_key(df, ["startTime"], order=["_rank", "_ingest"], descending=[True, True])
    return df.select(*K.WEATHER_COLUMNS)


def combine(alerts: DataFrame, weather: DataFrame,
            tolerance_seconds: float = K.ASOF_TOLERANCE_SECONDS, unique_weather: bool = False) -> DataFrame:
    """J2 + P7: each alert with the nearest weather hour within the tolerance;
    alerts without one are dropped. Inputs are the prepared (deduplicated)
    frames."""
    joined = asof_nearest(alerts, weather, "start", "startTime", tolerance_seconds, right_unique=unique_weather)
    return rename(joined, {"startTime": "weather_start", "endTime": "weather_end"})


def summarize(gold: DataFrame) -> DataFrame:
    """A1 over gold rows."""
    return daily_summary(gold)


def impact_view(fact: DataFrame) -> DataFrame:
    return impact_aggregate(fact)


def run_gold(spark: SparkSession, alerts_root: str, weather_root: str, gold_root: str,
             batch_id: int, export: bool = True,
             tolerance_seconds: float = K.ASOF_TOLERANCE_SECONDS) -> dict:
    """One gold run over silver snapshots (entry B)."""
    alerts = live_and_latest_history(spark, alerts_root, schemas.ALERT)
    weather = live_and_latest_history(spark, weather_root, schemas.WEATHER)
    if alerts is None or weather is None:
        return {"status": "missing silver input"}
    # weather is read several times by the join (bounds, windows): materialised
    # once; alert text is written once, as the joined rows that feed the fact
    # and the summary
    shared_dir(spark)
    prepared_weather = prepare_weather(weather).checkpoint(eager=True)
    staged = fresh_dir(spark, "gold-rows")
    (combine(prepare_alerts(alerts), prepared_weather, tolerance_seconds, unique_weather=True)
     .write.mode("overwrite").parquet(staged))
    gold = spark.read.schema(schemas.GOLD).parquet(staged)
    metrics = sinks.append_new(gold, f"{gold_root}/fact", batch_id, materialized=True)
    fact = sinks.read_fact(spark, f"{gold_root}/fact")
    metrics["summary_written"] = sinks.write_summary(summarize(gold), f"{gold_root}/daily_summary")
    remove_dir(spark, staged)
    if fact is not None:
        # the catalog's view needs a file to take its columns from
        view = (sinks.register_view(impact_view(fact)) if fact.isEmpty()
                else sinks.create_view(spark, f"{gold_root}/fact"))
        if export:
            metrics["exported"] = sinks.export_csv(view, f"{gold_root}/impact_export")
    return metrics
