"""A corpus from raw documents to packed sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensormart.llm.minhash import drop_near_duplicates
from sensormart.llm.mixing import take_mix
from sensormart.llm.packing import pack_documents
from sensormart.llm.quality import judge_documents
from sensormart.llm.suffixes import PASSAGE, remove_repeats
from sensormart.session import materialise, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; the labels of the same folder say which text is trusted.

    A null or empty text fails them. Null and repeated ids are judged row by row; a
    very long text is judged whole; an empty table gives no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_documents(docs, labels).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Documents without words belong to no group and stay. Of equal ids, null ones
    included, one row stays where their texts are alike. No rows, no rows.
    """
    return drop_near_duplicates(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere too; emptied documents stay as rows.

    A passage has ``PASSAGE`` bytes, about 50 short words: the 400 bytes that a
    string needs by default would leave passages of 50 words alone. Null texts stay
    null; null and repeated ids are documents like others; no rows, no rows.
    """
    return remove_repeats(docs, PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words are not taken.

    A null source is a source of its own; null and repeated ids are documents like
    others, told apart by their texts. No rows, no rows.
    """
    return take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, no piece across documents; a null text has its end id alone."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("mix", mix),
    ("pack", pack),
]

#: The stages cannot be expressed in SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written and read again for the next.

    What a stage has written on the way is removed once its rows are written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch():
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
