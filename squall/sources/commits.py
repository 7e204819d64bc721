"""S7's commit log: which folder of the fact holds the rows of which batch.

    fact/data/attempt=<name>/weather_date=<date>/*.parquet    written once, never changed
    fact/commits/<version>.json                               {"version", "attempt", "batches"}

A write becomes visible by one small file: the newest commit that names a batch
says which attempt holds it, and readers take a row only from that attempt. Until
then, and if the writer dies in between, they see the batch as it was. A commit
file is written aside and renamed to its version, which fails if that version is
there already, so two writers never publish over each other.

``compact`` rewrites the batches of many attempts as files of a target size and
publishes them by a commit of the same kind; ``vacuum`` removes what no commit
names any more.

Edge cases: no log means that there is no fact; an attempt without rows is a
commit like any other; rows of a retried batch inside a compacted attempt are
not read any more.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from squall import schemas
from squall.sources.snapshots import path_exists

# Only the folders of live attempts are listed when there are at most this many;
# beyond that all folders are, with the same result.
MAX_PRUNED_ATTEMPTS = 10_000
FILE_BYTES = 128 << 20
TASK_BYTES = 1 << 20  # of files to compact for each task, where there are as many dates

LOG = StructType([StructField("version", LongType()), StructField("attempt", StringType()),
                  StructField("batches", ArrayType(LongType()))])
ORDER = ("weather_date", "weather_start", "entity_id")


class Conflict(Exception):
    """Another writer has published a batch that this commit would replace."""


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return hadoop, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list:
    _, p, fs = _hadoop(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, fact_path: str) -> list[int]:
    names = [s.getPath().getName() for s in _listed(spark, f"{fact_path}/commits")]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def log(spark: SparkSession, fact_path: str) -> DataFrame | None:
    """All commits, or ``None`` if there is no fact."""
    if not versions(spark, fact_path):
        return None
    return spark.read.schema(LOG).json(f"{fact_path}/commits/*.json")


def live(commits: DataFrame) -> DataFrame:
    """(batch_id, attempt): the attempt that holds each batch."""
    each = commits.select("version", "attempt", F.explode("batches").alias("batch_id"))
    return each.groupBy("batch_id").agg(F.max_by("attempt", "version").alias("attempt"))


def holds(spark: SparkSession, fact_path: str, batch_id: int) -> bool:
    """Whether a commit names the batch."""
    commits = log(spark, fact_path)
    return commits is not None and not commits.where(F.array_contains("batches", int(batch_id))).isEmpty()


def read(spark: SparkSession, fact_path: str) -> DataFrame | None:
    """The fact as of its newest commit, or ``None`` if there is none."""
    commits = log(spark, fact_path)
    if commits is None:
        return None
    return _rows(spark, fact_path, live(commits))


def _rows(spark: SparkSession, fact_path: str, held: DataFrame) -> DataFrame:
    names = schemas.FACT.fieldNames()
    attempts = [r[0] for r in held.select("attempt").distinct().limit(MAX_PRUNED_ATTEMPTS + 1).collect()]
    data = f"{fact_path}/data"
    folders = [f"{data}/attempt={a}" for a in attempts] if len(attempts) <= MAX_PRUNED_ATTEMPTS else [data]
    rows = (spark.read.schema(StructType(schemas.FACT.fields + [StructField("attempt", StringType())]))
            .option("basePath", data).parquet(*folders))
    return rows.join(held, ["attempt", "batch_id"], "left_semi").select(*names)


def new_attempt() -> str:
    return "a" + uuid.uuid4().hex  # never read as a number by partition inference


def write_attempt(rows: DataFrame, fact_path: str, attempt: str) -> None:
    rows.write.mode("errorifexists").partitionBy("weather_date").parquet(f"{fact_path}/data/attempt={attempt}")


def publish(spark: SparkSession, fact_path: str, attempt: str, batches: list[int], read_version: int | None = None) -> int:
    """Make an attempt the holder of ``batches``; returns the commit's version.

    With ``read_version`` (a rewrite of what that version showed) it raises
    ``Conflict`` when a later commit names one of the batches."""
    hadoop, folder, fs = _hadoop(spark, f"{fact_path}/commits")
    fs.mkdirs(folder)
    context = hadoop.FileContext.getFileContext(folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plainly = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    checked = read_version
    while True:
        known = versions(spark, fact_path)
        if read_version is not None:
            for v in (v for v in known if v > checked):
                if set(_commit(spark, fact_path, v)["batches"]) & set(batches):
                    raise Conflict(f"commit {v} of {fact_path} names a batch that was to be rewritten")
            checked = max([checked, *known])
        version = known[-1] + 1 if known else 0
        record = json.dumps({"version": version, "attempt": attempt, "batches": [int(b) for b in batches]})
        aside = hadoop.Path(folder, f"_{uuid.uuid4().hex}")
        out = fs.create(aside, True)
        try:
            out.write(bytearray(record.encode()))
        finally:
            out.close()
        try:
            context.rename(aside, hadoop.Path(folder, f"{version:020d}.json"), plainly)
            return version
        except Py4JJavaError as exc:
            fs.delete(aside, False)
            if "FileAlreadyExists" not in exc.java_exception.getClass().getName():
                raise


def _commit(spark: SparkSession, fact_path: str, version: int) -> dict:
    row = spark.read.schema(LOG).json(f"{fact_path}/commits/{version:020d}.json").first()
    return {"version": row.version, "attempt": row.attempt, "batches": list(row.batches)}


def compact(spark: SparkSession, fact_path: str, file_bytes: int = FILE_BYTES, everything: bool = False) -> dict:
    """Rewrite the attempts of single batches as one attempt with files of about
    ``file_bytes``, clustered by date; with ``everything`` attempts of former
    compactions as well. The rows and their batch ids stay as they are. Files
    never span dates, so a task for each date writes at most twice as many as
    one task for all would.

    Readers see the old files until the commit. A batch that is appended again
    meanwhile makes it fail with ``Conflict`` and changes nothing.
    Returns ``{"batches": n, "attempts": n}`` of what was rewritten."""
    known = versions(spark, fact_path)
    if not known:
        return {"batches": 0, "attempts": 0}
    held = live(log(spark, fact_path))
    chosen: dict[str, list[int]] = {}
    for r in held.collect():
        chosen.setdefault(r.attempt, []).append(r.batch_id)
    if not everything:
        chosen = {a: b for a, b in chosen.items() if len(b) == 1}
    batches = sorted(b for some in chosen.values() for b in some)
    if len(chosen) < 2:
        return {"batches": 0, "attempts": 0}
    total, dates = 0, set()
    for attempt in chosen:
        _, p, fs = _hadoop(spark, f"{fact_path}/data/attempt={attempt}")
        total += fs.getContentSummary(p).getLength()
        dates |= {s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()}
    parts = max(1, math.ceil(total / file_bytes), min(len(dates), math.ceil(total / TASK_BYTES)))
    rows = _rows(spark, fact_path, held.where(F.col("attempt").isin(list(chosen))))
    attempt = new_attempt()
    write_attempt(rows.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER), fact_path, attempt)
    publish(spark, fact_path, attempt, batches, read_version=known[-1])
    return {"batches": len(batches), "attempts": len(chosen)}


def vacuum(spark: SparkSession, fact_path: str, keep_seconds: float = 7 * 86400) -> dict:
    """Remove attempts that hold no batch, and commits that no batch needs, once
    they are older than ``keep_seconds`` (longer than any read or write may take).

    Folders go first: a commit without its folder is superseded, so no reader
    asks for it."""
    commits = log(spark, fact_path)
    if commits is None:
        return {"attempts": 0, "commits": 0}
    wanted = {r[0] for r in live(commits).select("attempt").distinct().collect()}
    before = (time.time() - keep_seconds) * 1000
    old = {s.getPath().getName().partition("=")[2] for s in _listed(spark, f"{fact_path}/data")
           if s.isDirectory() and s.getModificationTime() < before} - wanted
    for attempt in old:
        _, p, fs = _hadoop(spark, f"{fact_path}/data/attempt={attempt}")
        fs.delete(p, True)
    gone = 0
    for r in commits.select("version", "attempt").collect():
        _, p, fs = _hadoop(spark, f"{fact_path}/commits/{r.version:020d}.json")
        data = f"{fact_path}/data/attempt={r.attempt}"
        if r.attempt not in wanted and fs.getFileStatus(p).getModificationTime() < before and not path_exists(spark, data):
            gone += bool(fs.delete(p, False))
    return {"attempts": len(old), "commits": gone}


def live_sql(fact_path: str) -> str:
    """The fact as of its newest commit as a SQL relation, resolved when it is queried."""
    return (f"(SELECT f.* FROM parquet.`{fact_path}/data` f LEFT SEMI JOIN (SELECT batch_id, max_by(attempt, version) AS attempt "
            f"FROM (SELECT version, attempt, explode(batches) AS batch_id FROM json.`{fact_path}/commits`) GROUP BY batch_id) c "
            f"ON f.attempt = c.attempt AND f.batch_id = c.batch_id)")
