from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, fp long, hash long, id string"


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def docs(spark: SparkSession) -> DataFrame:
    """The smallest documents."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and very long texts, repeated rows, and columns named
    like those that operators use inside."""
    rows = [
        (1, "the same text of more than five words here", "en", "a", 1, "x", 1, 1, "i"),
        (1, "the same text of more than five words here", "en", "a", 1, "x", 1, 1, "i"),
        (2, "the same text of more than five words here", "en", None, 1, None, None, None, None),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "", "", 0, "", 0, 0, ""),
        (5, " \t\n ", "de", "b", 4, "y", 2, 2, "j"),
        (6, LONG, "en", "a", len(LONG), "z", 3, 3, "k"),
        (None, "the same text of more than five words here", "en", "a", 1, "x", 1, 1, "i"),
        (None, None, None, None, None, None, None, None, None),
        (7, "Ünïcödé 日本語 \U0001f600 ok", "xx", "c", 5, "w", 4, 4, "l"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(odd: DataFrame) -> DataFrame:
    return odd.limit(0)
