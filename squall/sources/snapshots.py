"""Silver snapshot scans.

Silver layout: ``<root>/source=<live|historical>/ingest_ts=<instant>/part-*.parquet``.
``source`` and ``ingest_ts`` are partition columns, so "all live snapshots" and
"newest historical snapshot" are partition filters (pruned at listing time).
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, StructField, StructType, TimestampType)

from squall import constants as K
from squall import schemas
from squall.functions.timefn import lenient_timestamp
from squall.operators.dedup import latest_by


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_silver(spark: SparkSession, root: str, contract: StructType) -> DataFrame | None:
    """All snapshots under ``root`` with their ``source`` / ``ingest_ts`` tags."""
    if not path_exists(spark, root):
        return None
    schema = StructType(contract.fields + schemas.SNAPSHOT_TAGS.fields)
    return spark.read.schema(schema).parquet(root)


def live_and_latest_history(spark: SparkSession, root: str, contract: StructType) -> DataFrame | None:
    """S2 + S3 + U1: every live snapshot stacked with the newest historical one."""
    df = read_silver(spark, root, contract)
    if df is None:
        return None
    live = df.where(F.col("source") == K.SOURCE_LIVE)
    hist = latest_by(df.where(F.col("source") == K.SOURCE_HISTORICAL), "ingest_ts")
    return hist.unionByName(live)


def _headers(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """The header line of every file, from one distributed read of the files'
    first blocks: file, header."""
    lines = (spark.read.text(patterns)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
             .where(F.col("at") == 0))
    # a block is read by one task from its first line on, so the first value seen is the header
    return lines.groupBy("file").agg(F.first("value").alias("header"))


def _names(header: str) -> list[str]:
    return [h.strip() for h in next(csv.reader([header.lstrip("\ufeff")]))] if header else []


def _any_file(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or [])


def read_csv_by_name(spark: SparkSession, patterns: str | Sequence[str], contract: StructType) -> DataFrame | None:
    """CSV snapshots with a header, columns aligned by **name**.

    Spark's CSV reader binds a schema by position, so all files are read in one
    scan as numbered text columns, each row learns its file's header by a join on
    the file, and every contract column is taken from its place under that header.
    Only the different headers reach the driver. Records follow the
    usual quoting: a quoted field may hold commas, line breaks and doubled
    quotes. A contract column a file lacks is null (P9); of two columns of one
    name the first counts. Timestamps may carry
    offsets and are parsed to UTC (E1); numbers coerce (E16).
    """
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)
    patterns = [p for p in patterns if _any_file(spark, p)]
    if not patterns:
        return None
    headers = _headers(spark, patterns)
    places = {h: _names(h) for h, in headers.select("header").distinct().collect()}
    places = {h: names for h, names in places.items() if names}
    if not places:
        return None
    width = max(map(len, places.values()))
    text_schema = StructType([StructField(f"_c{i}", schemas.S) for i in range(width)])
    raw = (spark.read.schema(text_schema).option("header", True).option("enforceSchema", True)
           .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
           .option("multiLine", True).csv(patterns)
           .select("*", F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_modification_time").alias("ingest_ts"))
           .join(headers.where(F.col("header").isin(list(places))), "file"))
    cols = []
    for f in contract.fields:
        under = {}  # place of the column -> headers that have it there
        for h, names in places.items():
            if f.name in names:
                under.setdefault(names.index(f.name), []).append(h)
        value = F.coalesce(F.lit(None).cast("string"),
                           *(F.when(F.col("header").isin(hs), F.col(f"_c{i}")) for i, hs in sorted(under.items())))
        if isinstance(f.dataType, TimestampType):
            cols.append(lenient_timestamp(value).alias(f.name))
        elif isinstance(f.dataType, DoubleType):
            cols.append(value.try_cast("double").alias(f.name))
        else:
            cols.append(value.cast(f.dataType).alias(f.name))
    return raw.select(*cols, "ingest_ts")
