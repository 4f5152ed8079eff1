"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, is written as Parquet to the shared folder
and read again as the next one's documents. All but the last return the columns of
``documents``. The stages learn or search on their own input only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import language_spans, near_duplicates, packing, personal_data, winnowing
from rankloom.llm.common import ROW, table
from rankloom.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with less than half of their words in one, go."""
    return language_spans.accepted(docs, language_spans.trained(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return near_duplicates.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return winnowing.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return personal_data.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of fixed length."""
    return packing.packed(docs).drop(ROW)


STAGES = [
    ("language_id", language),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", redact),
    ("packing", pack),
]

#: Models, iteration and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
