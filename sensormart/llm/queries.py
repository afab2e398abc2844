"""One query per operator, over its whole table, and the SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormart.llm.clusters import cluster_vectors
from sensormart.llm.common import table
from sensormart.llm.fingerprints import compare_with_edits
from sensormart.llm.licenses import scan_licenses
from sensormart.llm.minhash import near_duplicates
from sensormart.llm.mixing import mix_documents
from sensormart.llm.oracles import CLUSTERS, MINHASH, MIXING, SEARCH, VECTORS, WARC
from sensormart.llm.packing import pack_documents
from sensormart.llm.quality import document_verdicts
from sensormart.llm.search import search
from sensormart.llm.suffixes import PASSAGE, find_repeats
from sensormart.llm.token_counts import count_tokens
from sensormart.llm.token_files import read_token_files, write_token_files
from sensormart.llm.vectors import near_vectors
from sensormart.llm.warc import read_warc, write_warc


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(table(spark, sf_dir, "documents"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents"), passage=PASSAGE).drop("spans", "passages")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_warc(write_warc(table(spark, sf_dir, "pages"))).drop("payload")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "component")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_files": op3_token_files,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_minhash": op10_minhash,
    "op11_search": op11_search,
    "op12_fingerprints": op12_fingerprints,
    "op13_clusters": op13_clusters,
}

ORACLE_SQL = {
    "op6_embedding_dedup": VECTORS,
    "op7_warc": WARC,
    "op8_mixing": MIXING,
    "op10_minhash": MINHASH,
    "op11_search": SEARCH,
    "op13_clusters": CLUSTERS,
}
