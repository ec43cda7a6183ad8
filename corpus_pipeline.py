"""The corpus pipeline: language ID, line dedup, near-dedup, pseudonyms, packing.

Every stage takes and returns the columns of ``documents``, but for the last, which
returns packed pieces. A stage that changes texts sets ``n_chars`` to their new length.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.langid import keep_known
from tidewarden.llm.linededup import dedup_lines
from tidewarden.llm.packing import pack_documents
from tidewarden.llm.pii import pseudonymise
from tidewarden.llm.queries import KEY
from tidewarden.llm.simhash import keep_first
from tidewarden.sources.shared import new_steps

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that other documents repeat."""
    return _measured(dedup_lines(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return keep_first(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return _measured(pseudonymise(docs, KEY), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

ORACLE_SQL = None
"""SQL cannot express the model, the hashes and the tokens; tests use brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table the next one reads."""
    step = new_steps(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = step(stage(spark, docs, sf_dir), name)
    return docs
