"""Small column expressions and frame helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
"""White space between words."""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Plain ASCII takes the faster way to the same."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words between white space; an empty array for a null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITE)
    return F.filter(parts, lambda w: w != "")


ROW = ("__row_a", "__row_b")
"""Columns that tell a row from others, by 128 bits."""
_SECOND = 0x5EED


def row_key(df: DataFrame) -> list[Column]:
    """The columns ``ROW``: two hashes of the whole row, the second with another seed. So
    two different rows of 1e11 share them with a chance of 1e-17."""
    whole = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*whole).alias(ROW[0]), F.xxhash64(F.lit(_SECOND), *whole).alias(ROW[1])]


def select_as(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no other column
    of the input can clash with those the operator adds."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def with_outputs(rows: DataFrame, columns: list[str], **outputs: Column) -> DataFrame:
    """The fields ``columns`` of a struct column ``row`` and the operator's outputs. An
    output replaces an input column of its name and stands in its place."""
    kept = [outputs[c].alias(c) if c in outputs else F.col("row").getField(c).alias(c) for c in columns]
    return rows.select(*kept, *[v.alias(k) for k, v in outputs.items() if k not in columns])


def hash_share(df: DataFrame, column: str, rows: int) -> DataFrame:
    """About ``rows`` of the rows: those whose 64-bit hash lies in the lowest share of all
    values that is made for so many. No sort, and the same rows whatever the order."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.col(column) < -(2**63) + int(2**64 * (rows / n)))
