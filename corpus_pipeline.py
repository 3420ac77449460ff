"""From raw documents to packed training batches, stage by stage.

Every stage works on all that the one before it kept. Between stages the
documents are written as Parquet in the folder all executors share and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import exact_dedup, langid, ngram_join, packing, pii
from rollcall.llm.support import Scratch, table


def language(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Drop documents without a letter, and longer ones unlike any language that could be learned."""
    return langid.identified(docs)


def copies(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Keep the document with the smallest doc_id of equal texts."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each component of similar texts."""
    return ngram_join.one_of_each(docs)


def privacy(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Put marks in the place of personal data."""
    return pii.masked(docs)


def batches(spark: SparkSession, docs: DataFrame, directory: str) -> DataFrame:
    """Deal the documents out to length buckets and token-budget batches."""
    return packing.packed(docs, packing.words(F.col("text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("copies", copies),
    ("near_copies", near_copies),
    ("privacy", privacy),
    ("batches", batches),
]

# Profiles, message passing and the choice of buckets are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, directory), name)
    return STAGES[-1][1](spark, docs, directory)
