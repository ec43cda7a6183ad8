"""Each operator applied to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytebpe import token_digests
from .counttree import apply_edits, count_trees
from .covertree import product_codes
from .fingerprint import fingerprint_edits
from .langid import accepted, fit, identify, page_rows
from .licensescan import scan_licenses
from .linededup import dedup_lines
from .packing import pack_documents
from .permindex import nearest
from .pii import pseudonymise
from .rtree import hard_negatives
from .simhash import near_duplicates
from .sql import oracle_sql as _oracle_sql
from .suffixes import repeated_passages
from .vectors import finite, floored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(_table(spark, sf, "documents"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Documents (declared language, source) and web pages (markup, address, host)."""
    docs, pages = _table(spark, sf, "documents"), _table(spark, sf, "pages")
    none = F.lit(None).cast("string")
    evidence = ("text", "declared", "suffix", "host")
    rows = docs.select(
        "doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", F.col("lang").alias("declared"),
        none.alias("suffix"), F.col("source").alias("host"),
    ).unionByName(page_rows(pages).select(F.lit(None).cast("bigint").alias("doc_id"), "page_id", *evidence))
    found = identify(rows, fit(docs, "text", "lang"))
    return found.withColumn("kept", accepted(found))


def op3_simhash_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"))


def op4_permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


KEY = b"test tables only"
"""Where data are real, the key comes from whoever keeps it."""


def op5_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    found = pseudonymise(_table(spark, sf, "documents"), KEY)
    return found.select("doc_id", "text", "n_pii", "pii_spans")


def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(_table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_edit_aware_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts before and after three edits of every document: 20 characters upper-cased
    a third into it, its beginning put in two thirds into it, and its end cut off."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    n = F.length("text")
    third, end = F.floor(n / 3), F.greatest(F.lit(0), n - 30)
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), new.alias("text"))
    edits = F.array(
        edit(third, third + 20, F.upper(F.substring("text", third.cast("int") + 1, F.lit(20)))),
        edit(2 * third, 2 * third, F.concat(F.lit(" "), F.left("text", F.lit(10)))),
        edit(end, n + 100, F.lit("")),
    )
    state = count_trees(_table(spark, sf, "documents"), path, pattern).withColumn("edits", edits)
    edited = apply_edits(state, path, pattern)
    return edited.select(
        F.col("id").alias("doc_id"), "n_before", "n_tokens", "recoded", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("text", 256).alias("edited_sha256"),
    )


def op9_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf, "documents"))


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings").where(finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), floored(F.col("embedding")).alias("embedding"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings").where(finite(F.col("embedding")))
    return product_codes(rows.select("vec_id", "label", floored(F.col("embedding")).alias("embedding")))


def op13_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(_table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return _oracle_sql()
