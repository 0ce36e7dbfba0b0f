"""From raw documents to training tokens: rules, near duplicates, repeated passages, mixing, encoding.

Each stage is written as Parquet and read again as the next one's input, by the driver or by run() below, so a lost executor
costs the tasks of one stage. All but the last return the columns of documents, in their order, others of any name too.

Null, empty and blank texts break the rules and go in the first stage; a stage that meets them keeps them. Texts of any length
are taken whole. A null key is a key like others; rows that repeat key and text are copies. An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from granary.llm import bpe, jaccard, mixing, passages, quality
from granary.llm.common import heaps_let_go, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, one with the least id, of each class of near duplicates; texts without words are in no class and stay."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id holds too; what is cut may leave a text empty."""
    return passages.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times; null sources are one source, texts without words have size 0."""
    return mixing.mixture(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of tokens, and SHA-256 of the token ids and of the decoded text, for each document of the mix."""
    heaps_let_go(spark)  # tokenizers need the room
    return bpe.digests(docs, ["doc_id", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("encoded", encoded),
]

#: Near duplicates, passages and tokens have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents. Stages are kept in the folder of spark.checkpoint.dir."""
    place = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{place}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
