"""T3's waiting room: alerts without a weather hour, in buckets by start day.

Layout: ``bucket=<day since 1970>/seen=<n>/round=<r>``; ``seen`` is the number of
weather hours within reach of the bucket when its rows were last tried, ``round``
the micro-batch (or retry) that left them. A bucket is due when that number is
another now; its rows are read and tried, the others are not touched.

What a round takes up is noted before anything is written (``_taken/<round>``) and
stays on disk until the round can no longer be replayed (``settle``), so a
replay starts from the same rows. A round's own leavings are removed before it
is played again. ``_work`` holds the steps of the round at hand.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from squall import schemas
from squall.sources.sinks import MAX_PRUNED_DATES

BUCKET_SECONDS = 24 * 3600


class Waiting(NamedTuple):
    """One folder of waiting alerts."""

    bucket: int
    seen: int
    round: int

    def path(self, root: str) -> str:
        return f"{root}/bucket={self.bucket}/seen={self.seen}/round={self.round}"


def bucket_of(start: str = "start"):
    return F.floor(F.unix_micros(start) / F.lit(BUCKET_SECONDS * 1_000_000))


class PendingAlerts:
    def __init__(self, spark: SparkSession, root: str, tolerance_seconds: float) -> None:
        self.spark, self.root, self.tolerance = spark, root.rstrip("/"), tolerance_seconds

    # -- folders (names only) --

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def folders(self) -> list[Waiting]:
        found = self._fs().globStatus(self._path(f"{self.root}/bucket=*/seen=*/round=*")) or []
        jvm = self.spark.sparkContext._jvm
        # all paths in one string: a call for each of thousands of folders would take seconds
        listed = jvm.scala.runtime.ScalaRunTime.stringOf(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)) if found else ""
        return sorted(Waiting(*map(int, f)) for f in re.findall(r"/bucket=(-?\d+)/seen=(\d+)/round=(\d+)", listed))

    def _remove(self, folders: list[Waiting]) -> None:
        if not folders:
            return
        kept = {f.bucket for f in set(self.folders()) - set(folders)}
        paths = {f.path(self.root) if f.bucket in kept else f"{self.root}/bucket={f.bucket}" for f in folders}
        fs = self._fs()
        for path in sorted(paths):
            fs.delete(self._path(path), True)

    # -- what a round takes up --

    def rounds(self) -> list[int]:
        """Rounds that are noted and not settled."""
        found = self._fs().globStatus(self._path(f"{self.root}/_taken/*")) or []
        return sorted(int(s.getPath().getName()) for s in found if s.getPath().getName().isdigit())

    def take(self, number: int, folders: list[Waiting]) -> None:
        """Note what a round takes up; the note appears whole or not at all."""
        draft, note = self._path(f"{self.root}/_taken/_{number}"), self._path(f"{self.root}/_taken/{number}")
        out = self._fs().create(draft, True)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        if not self._fs().rename(draft, note):
            raise OSError(f"cannot note what round {number} takes up in {self.root}")

    def taken(self, number: int) -> list[Waiting]:
        text = self.spark.sparkContext._jvm.scala.io.Source
        stream = self._fs().open(self._path(f"{self.root}/_taken/{number}"))
        try:
            listed = json.loads(text.fromInputStream(stream, "UTF-8").mkString())
        finally:
            stream.close()
        there = set(self.folders())
        return [w for w in (Waiting(*x) for x in listed) if w in there]

    def settle(self, number: int) -> None:
        """A round is over: what it took up is gone, then its note."""
        self._remove(self.taken(number))
        self._fs().delete(self._path(f"{self.root}/_taken/{number}"), False)

    def remove_round(self, number: int) -> None:
        self._remove([f for f in self.folders() if f.round == number])

    # -- steps of the round at hand --

    def step(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` written beside what waits and read again, until ``clear``."""
        path = f"{self.root}/_work/{name}"
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def clear(self) -> None:
        self._fs().delete(self._path(f"{self.root}/_work"), True)

    # -- rows --

    def read(self, folders: list[Waiting]) -> DataFrame:
        return self.spark.read.schema(schemas.ALERT).parquet(*(f.path(self.root) for f in folders))

    def reach(self, hours: DataFrame) -> DataFrame:
        """Buckets within the tolerance of a weather hour, and of how many: bucket, n."""
        reach, unit = int(self.tolerance * 1_000_000), F.lit(BUCKET_SECONDS * 1_000_000)
        at = F.unix_micros("startTime")
        span = F.sequence(F.floor((at - reach) / unit), F.floor((at + reach) / unit))
        return hours.select(F.explode(span).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))

    def due(self, reach: DataFrame, old_before: int | None = None) -> list[Waiting]:
        """The folders whose weather hours have become others, and those of days
        that ended before ``old_before``; what unsettled rounds have taken up is theirs."""
        busy = {w for n in self.rounds() for w in self.taken(n)}
        free = [f for f in self.folders() if f not in busy]
        if not free:
            return []
        # one row per waiting day
        asked = self.spark.createDataFrame([(b,) for b in sorted({f.bucket for f in free})], "bucket long")
        now = {r["bucket"]: r["n"] for r in asked.join(reach, "bucket").collect()}
        old = lambda f: old_before is not None and (f.bucket + 1) * BUCKET_SECONDS * 1_000_000 <= old_before
        return [f for f in free if now.get(f.bucket, 0) != f.seen or old(f)]

    def beside(self, rows: DataFrame, but: list[Waiting]) -> DataFrame | None:
        """Alerts that wait in the buckets of ``rows``, those of ``but`` left out."""
        there = set(self.folders()) - set(but)
        if not there:
            return None
        buckets = {r[0] for r in rows.select(bucket_of()).distinct().limit(MAX_PRUNED_DATES + 1).collect()}
        if len(buckets) <= MAX_PRUNED_DATES:
            there = {f for f in there if f.bucket in buckets}
        return self.read(sorted(there)) if there else None

    def write(self, rows: DataFrame, number: int, reach: DataFrame) -> int:
        """Leave alerts waiting; how many. ``rows`` lie in ranges of ``start``, so
        they are written as they are; ``reach`` has one row per day."""
        obs = Observation(f"pending_{number}")
        tagged = (rows.withColumn("bucket", bucket_of()).join(F.broadcast(reach), "bucket", "left")
                  .withColumns({"seen": F.coalesce("n", F.lit(0)), "round": F.lit(number).cast("long")}).drop("n"))
        (tagged.observe(obs, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").option("compression", "zstd").partitionBy("bucket", "seen", "round").parquet(self.root))
        return int(obs.get.get("rows", 0) or 0)
