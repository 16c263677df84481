"""The corpus pipeline: documents through the text operators, one stage after another.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the docs of
the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, packing, secret_scan, simhash
from tidemark.llm.common import files_of, ship_package, small_batches, stored, table
from tidemark.llm.exact_dedup import DigestIndex
from tidemark.llm.queries import ENCODER


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; text in none of them goes."""
    _ready(spark)
    found = langid.document_languages(docs, langid.train(docs))
    return found.where(~F.col("language").eqNullSafe(langid.UNKNOWN)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every text, the one with the largest id."""
    return DigestIndex.scratch(spark, files_of(docs.count())).ingest(docs, "documents")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id."""
    _ready(spark)
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    _ready(spark)
    return secret_scan.mask(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their sequences."""
    _ready(spark)
    return packing.pack(docs, ENCODER)


STAGES = [
    ("language id", language_id),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("secret scan", secrets),
    ("best-fit packing", pack),
]

# Trained and iterative stages have no SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
