"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from squall.llm import (audit, licenses, mixing, packing, pivots, repair, rules, shards, simhash, syncmers, toxicity, trie,
                        warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families named in each document."""
    return licenses.scan_documents(_table(spark, sf_dir, "documents"))


def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files with Re-Pair grammars over all documents, read back."""
    return repair.token_files_roundtrip(_table(spark, sf_dir, "documents"))


def op3_warc_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back record by record."""
    return warc.archive_roundtrip(_table(spark, sf_dir, "pages")).drop("target_uri")


ORACLE_OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, max(page_id) AS first FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into eight shards."""
    return shards.shard_documents(_table(spark, sf_dir, "documents"))


def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprints of all documents and of their edited texts."""
    return syncmers.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the groups they form."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op9_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows for every hundredth vector."""
    return pivots.top_k(_table(spark, sf_dir, "embeddings"))


def op10_hypergeometric_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mixture of all documents to target weights takes of each."""
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations with shared starts."""
    return trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, in every order."""
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents")
    return rules.score_documents(docs, rules.train(docs, _table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_repair_tokens": op2_repair_tokens,
    "op3_warc_reader": op3_warc_reader,
    "op4_vector_packing": op4_vector_packing,
    "op5_external_shuffle": op5_external_shuffle,
    "op6_closed_syncmers": op6_closed_syncmers,
    "op7_kneser_ney_toxicity": op7_kneser_ney_toxicity,
    "op8_simhash_pigeonring": op8_simhash_pigeonring,
    "op9_pivot_index": op9_pivot_index,
    "op10_hypergeometric_mixing": op10_hypergeometric_mixing,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_rule_quality": op13_rule_quality,
}

ORACLES: dict[str, str] = {
    "op3_warc_reader": ORACLE_OP3,
    "op9_pivot_index": pivots.ORACLE,
    "op10_hypergeometric_mixing": mixing.ORACLE,
    "op11_conversation_trie": trie.ORACLE,
    "op12_filter_audit": audit.ORACLE,
}
