"""Vectors as integers, as operators on exact arithmetic read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Not null, and without null or non-finite components. An empty vector is finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def floored(vector: Column, scale: int = 256) -> Column:
    """Each component as the floor of ``scale`` times it, as a 64-bit integer."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * float(scale)))


def equal_length(df: DataFrame, column: str, multiple: int = 1) -> tuple[DataFrame, int]:
    """``df`` with vectors of one length, that of the longest raised to a multiple, by
    zeros at the end; and that length, which is 0 for an empty table."""
    ends = df.agg(F.min(F.size(column)).alias("least"), F.max(F.size(column)).alias("most")).first()
    if ends["most"] is None:
        return df, 0
    width = max(1, -(-ends["most"] // multiple)) * multiple
    if ends["least"] == width:
        return df, width
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(column))
    return df.withColumn(column, F.concat(F.col(column), zeros)), width
