"""T2's memory: the keys of all snapshots of a source, by start date.

The ledger lies beside the snapshots (``_<name>_keys``):
``source=<s>/start_date=<d>/ingest_ts=<t>``. A poll reads the folders of the dates
it touches and no others, so its cost does not grow with the history. A snapshot
that reached silver without its keys (an import, a poll cut off before they
were written) is found by comparing folder names and added before the next look-up.
A replayed poll writes the same folders again; its own keys are never known to it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from squall import schemas
from squall.functions.timefn import utc_date
from squall.sources.sinks import MAX_PRUNED_DATES


class KeyLedger:
    """``key`` is the schema of the key columns; ``start`` is one of them."""

    def __init__(self, spark: SparkSession, silver_root: str, source: str, key: StructType) -> None:
        self.spark, self.source, self.key = spark, source, key
        parent, _, name = silver_root.rstrip("/").rpartition("/")
        self.silver_root = silver_root.rstrip("/")
        self.snapshots = f"{self.silver_root}/source={source}"
        self.root = f"{parent}/_{name}_keys/source={source}" if parent else f"_{name}_keys/source={source}"
        self.marks = f"{self.root}/_done"

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> set[str]:
        fs, path = self._fs(), self._path(folder)
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    def _folder(self, taken: dt.datetime) -> str:
        """The folder name that Spark gives a snapshot's partition."""
        text = self.spark.range(1).select(F.lit(taken).cast("timestamp").cast("string")).first()[0]
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"ingest_ts={escape(text)}"

    def _add(self, names: list[str]) -> None:
        tags = schemas.SNAPSHOT_TAGS.fields
        rows = (self.spark.read.schema(StructType(self.key.fields + tags)).option("basePath", self.silver_root)
                .parquet(*(f"{self.snapshots}/{n}" for n in names)))
        keys = rows.where(F.col("start").isNotNull()).select(
            *self.key.fieldNames(), utc_date("start").alias("start_date"), "ingest_ts").distinct()
        (keys.repartitionByRange("start_date", "ingest_ts").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("start_date", "ingest_ts").parquet(self.root))
        for n in names:
            self._fs().create(self._path(f"{self.marks}/{n}"), True).close()

    def catch_up(self) -> list[str]:
        """Add the keys of snapshots that the ledger does not have; their folder names."""
        missing = sorted(n for n in self._names(self.snapshots) - self._names(self.marks) if n.startswith("ingest_ts="))
        if missing:
            self._add(missing)
        return missing

    def record(self, taken: dt.datetime) -> None:
        """Add the keys of the snapshot just written; it may hold no rows."""
        name = self._folder(taken)
        if name in self._names(self.snapshots):
            self._add([name])

    def known(self, rows: DataFrame, but: dt.datetime) -> DataFrame | None:
        """The keys of other snapshots than ``but`` on the start dates of
        ``rows``; beyond ``MAX_PRUNED_DATES`` dates all of them."""
        held = {n for n in self._names(self.root) if n.startswith("start_date=")}
        if not held:
            return None
        dates = [r[0] for r in rows.select(utc_date("start").alias("d")).distinct().limit(MAX_PRUNED_DATES + 1).collect()]
        schema = StructType([*self.key.fields, StructField("start_date", DateType()), *schemas.SNAPSHOT_TAGS.fields[1:]])
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        if len(dates) > MAX_PRUNED_DATES:
            keys = reader.parquet(self.root)
        else:
            # only these folders are listed at all
            paths = [f"{self.root}/start_date={d}" for d in dates if f"start_date={d}" in held]
            if not paths:
                return None
            keys = reader.parquet(*paths).where(F.col("start_date").isin(dates))
        return keys.where(F.col("ingest_ts") != F.lit(but).cast("timestamp")).select(*self.key.fieldNames())
