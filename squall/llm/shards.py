"""Two-pass external shuffle of a corpus into shards.

Pass one scatters every record to a bucket chosen uniformly by a seeded hash of
the record's place (its file and row), so equal keys, texts and sources spread like
any others. The number of buckets follows from the corpus size so that one
bucket fits in a task's memory. Pass two takes each bucket as a whole, orders it
by a seeded Fisher-Yates shuffle and writes it. Buckets laid end to end are one
shuffled order of the corpus; the shards are its equal runs, so their row counts
differ by one at most (law ``rows``).

The method scatters copies of a text like any other records, so it does not keep
equal texts together.

Edge cases: null text has size 1 and checksum 0 like an empty one; repeated rows
and null doc_ids are records of their own; with fewer rows than shards the last
shards are empty; an empty table gives no row. Other input columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from squall.llm.common import placed, scratch, ship

BUCKET_BYTES = 24 << 20
SEED = 20240607


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The bucket's order: numpy's shuffle is the Fisher-Yates algorithm."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def shuffle_to_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = SEED,
                      bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` (doc_id, text) to ``path`` as Parquet, partitioned by
    shard, and return the table read back: doc_id, text, shard, slot."""
    spark = docs.sparkSession
    ship(spark)
    docs, place = placed(docs)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), place.alias("place"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(buckets)).cast("int"))
    # one row per bucket: where it begins in the shuffled order, and how many rows there are
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    bounds = sizes.select("bucket", F.sum("n").over(Window.orderBy("bucket")).alias("upto"), "n",
                          F.sum("n").over(Window.partitionBy()).alias("total"))
    bounds = bounds.select("bucket", (F.col("upto") - F.col("n")).alias("first"), "total")

    def order(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        n = table.num_rows
        # rows arrive in any order; the shuffle starts from the order of their places
        arrived = np.argsort(table.column("place").to_numpy(), kind="stable")
        table = table.take(pa.array(arrived[fisher_yates(n, seed, bucket)]))
        first, whole = table.column("first")[0].as_py(), table.column("total")[0].as_py()
        at = np.arange(first, first + n, dtype=np.int64)
        shard = shard_of(at, whole, shards)
        return pa.table({"doc_id": table.column("doc_id"), "text": table.column("text"),
                         "shard": pa.array(shard.astype(np.int32)), "slot": at - shard_start(shard, whole, shards)})

    # the bounds are joined after the scatter; one small row per bucket
    joined = scattered.join(F.broadcast(bounds) if buckets <= 50_000 else bounds, "bucket")
    # a partition for each bucket, so that no task takes several of them
    (joined.repartitionById(buckets, "bucket").groupBy("bucket").applyInArrow(order, "doc_id long, text string, shard int, slot long")
     .write.partitionBy("shard").parquet(path))
    return spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)


def shard_start(shard: np.ndarray, total: int, shards: int) -> np.ndarray:
    """First place of a shard in the shuffled order: the first ``total % shards``
    shards hold one row more."""
    return shard * (total // shards) + np.minimum(shard, total % shards)


def shard_of(at: np.ndarray, total: int, shards: int) -> np.ndarray:
    each, more = divmod(total, shards)
    large = more * (each + 1)
    return np.where(at < large, at // (each + 1), more + (at - large) // max(each, 1))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """Shuffle documents into shards in the shared folder; digest of what was
    written: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    written = shuffle_to_shards(docs, scratch(docs.sparkSession, "shards"), shards, seed)
    return written.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
