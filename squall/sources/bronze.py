"""S4 — bronze JSON documents, read with an explicit schema (no inference)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from squall import schemas
from squall.operators.dedup import latest_by


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
              multiline: bool = True) -> DataFrame:
    """One multi-line JSON document (or a top-level array of records) per file.

    Adds ``ingest_ts`` = the file's modification time, the snapshot clock.
    No matching file gives an empty frame with the schema (not an error).
    A multi-line document is parsed by one task; large archives should land as
    JSON lines (``multiline=False``), which are split.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    existing = [p for p in paths if _matches(spark, p)]
    if not existing:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("ingest_ts", F.lit(None).cast("timestamp"))
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    df = reader.json(existing)
    return df.withColumn("ingest_ts", F.col("_metadata.file_modification_time"))


def _glob(spark: SparkSession, pattern: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, list(fs.globStatus(p) or [])


def _statuses(spark: SparkSession, pattern: str):
    """Data files matched by a path, glob or directory (hidden files skipped)."""
    fs, found = _glob(spark, pattern)
    files = []
    for st in found:
        for f in ([st] if st.isFile() else list(fs.listStatus(st.getPath()))):
            name = f.getPath().getName()
            if f.isFile() and not name.startswith(("_", ".")):
                files.append(f)
    return files


def _matches(spark: SparkSession, pattern: str) -> bool:
    return bool(_glob(spark, pattern)[1])


def newest_snapshot(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[str], dt.datetime | None]:
    """S1 / A8 on the file listing: the file(s) with the newest modification
    time, and that time (UTC). Only metadata is listed; no data is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = [st for p in paths for st in _statuses(spark, p)]
    if not found:
        return [], None
    newest = max(st.getModificationTime() for st in found)
    files = sorted(str(st.getPath().toString()) for st in found if st.getModificationTime() == newest)
    return files, dt.datetime.fromtimestamp(newest / 1000, dt.timezone.utc).replace(tzinfo=None)


def newest_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    return newest_snapshot(spark, paths)[0]


def latest_snapshot(df: DataFrame, column: str = "ingest_ts") -> DataFrame:
    """S1 / A8 on a DataFrame: keep only the newest snapshot's rows."""
    return latest_by(df, column)


def read_feed(spark, paths, schema, latest_only: bool = True, multiline: bool = True) -> DataFrame:
    """S1 + S4: the newest file (or all files) of a feed."""
    if latest_only:
        paths = newest_files(spark, paths) or paths
    return read_json(spark, paths, schema, multiline)


def live_alert_feed(spark, paths, latest_only: bool = True) -> DataFrame:
    return read_feed(spark, paths, schemas.LIVE_ALERT_FEED, latest_only)


def live_weather_doc(spark, paths, latest_only: bool = True) -> DataFrame:
    return read_feed(spark, paths, schemas.LIVE_WEATHER_DOC, latest_only)


def historical_alert_records(spark, paths, latest_only: bool = True) -> DataFrame:
    return read_feed(spark, paths, schemas.HISTORICAL_ALERT_RECORD, latest_only)


def historical_weather_doc(spark, paths, latest_only: bool = True) -> DataFrame:
    return read_feed(spark, paths, schemas.HISTORICAL_WEATHER_DOC, latest_only)
