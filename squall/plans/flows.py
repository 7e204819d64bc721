"""The four bronze -> silver flows and the gold flow, composed from the
sources, transforms and sinks (one call per run, as a scheduler or
spark-submit would invoke them).

Each silver flow reads the newest bronze file (S1), transforms it, removes
exact duplicates (A6), and writes one snapshot partition (S6) tagged with the
bronze file's modification time, so re-running on the same file replaces the
same snapshot. Nothing is written for an empty result (F6).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall import constants as K
from squall.operators.dedup import distinct_rows
from squall.plans import gold, silver
from squall.sources import bronze, sinks


def _silver_flow(spark: SparkSession, read: Callable, transform: Callable[[DataFrame], DataFrame],
                 bronze_paths: str | Sequence[str], silver_root: str, source: str) -> dict:
    """Newest bronze file -> one snapshot partition. Bronze is parsed once: the
    snapshot time comes from the file listing, the row count from the write. An
    empty result writes no file and leaves no snapshot (F6)."""
    files, taken = bronze.newest_snapshot(spark, bronze_paths)
    if not files:
        return {"rows": 0, "written": False}
    rows = distinct_rows(transform(read(spark, files, latest_only=False).drop("ingest_ts")))
    out = sinks.write_snapshot(rows, silver_root, source, taken)
    if not out["rows"]:
        return {"rows": 0, "written": False}
    return {**out, "written": True, "snapshot": taken}


def alerts_live(spark, bronze_paths, silver_root) -> dict:
    return _silver_flow(spark, bronze.live_alert_feed, silver.live_alert_rows, bronze_paths, silver_root,
                        K.SOURCE_LIVE)


def alerts_historical(spark, bronze_paths, silver_root, source_tz: str | None = None) -> dict:
    return _silver_flow(spark, bronze.historical_alert_records,
                        lambda df: silver.historical_alert_rows(df, source_tz), bronze_paths, silver_root,
                        K.SOURCE_HISTORICAL)


def weather_live(spark, bronze_paths, silver_root) -> dict:
    return _silver_flow(spark, bronze.live_weather_doc, silver.live_weather, bronze_paths, silver_root,
                        K.SOURCE_LIVE)


def weather_historical(spark, bronze_paths, silver_root) -> dict:
    return _silver_flow(spark, bronze.historical_weather_doc, silver.historical_weather, bronze_paths,
                        silver_root, K.SOURCE_HISTORICAL)


def import_csv_snapshots(spark, patterns, contract, silver_root: str, source: str) -> dict:
    """Bring existing CSV snapshots (one file per poll, columns in any order)
    into the silver layout: aligned by name (S5), each file becomes the
    snapshot of its modification time (S6). Re-importing replaces the same
    snapshot partitions."""
    from squall.sources.snapshots import read_csv_by_name
    df = read_csv_by_name(spark, patterns, contract)
    if df is None:
        return {"rows": 0, "written": False}
    tagged = df.withColumn("source", F.lit(source))
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "ingest_ts").parquet(silver_root))
    return {"written": True}


def gold_run(spark, alerts_root, weather_root, gold_root, batch_id: int, export: bool = True) -> dict:
    return gold.run_gold(spark, alerts_root, weather_root, gold_root, batch_id, export=export)


def run_all(spark, alert_bronze, weather_bronze, silver_root: str, gold_root: str, batch_id: int,
            export: bool = True) -> dict:
    """One poll: both live silver flows, then gold."""
    return {"alerts": alerts_live(spark, alert_bronze, f"{silver_root}/alerts"),
            "weather": weather_live(spark, weather_bronze, f"{silver_root}/weather"),
            "gold": gold_run(spark, f"{silver_root}/alerts", f"{silver_root}/weather", gold_root, batch_id, export)}
