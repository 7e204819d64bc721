"""From raw documents to packed training sequences.

Each stage is a function (spark, docs, sf_dir) that returns what it keeps; its
result is written as Parquet and read again as the next stage's documents. All
but the last return the columns of ``documents``. A document that the mixture
takes twice is two rows after that stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from squall.llm import mixing, packing, simhash, toxicity
from squall.llm.common import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' documents as often as the target weights take them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("packing", pack_sequences),
]

# packing needs a tokenizer, which SQL does not have
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs
