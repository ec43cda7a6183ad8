"""Column types of CSV tables, found from all their rows.

Types form a lattice: bigint below decimal(38,0) (whole numbers beyond 64 bits, so that none
loses digits) below double below string, date below timestamp below string,
boolean below string. Digits after a leading zero or plus, such as postal codes, are text,
as a number would lose them. The type of a column is the least that holds all its values. Which
types hold a value is a conjunction over rows, so one aggregate of a few flags per column
finds all types of a table in one scan, combined on the map side; no sample decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# From narrow to wide: the text that a value must have, and the type that must hold it.
TEXTS = {
    "boolean": r"(?i)^(true|false)$",
    "bigint": r"^-?(0|[1-9][0-9]*)$",
    "decimal(38,0)": r"^-?(0|[1-9][0-9]*)$",
    "double": r"^-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?)?$",
}
WIDEST = "string"


def _holds(kind: str, column: str) -> Column:
    value = F.trim(F.col(f"`{column}`"))
    return F.when(value.isNotNull(), value.rlike(TEXTS[kind]) & value.try_cast(kind).isNotNull())


def column_types(df: DataFrame) -> DataFrame:
    """``(position, column_name, column_type, n_values)`` of a table of strings.

    ``n_values`` counts what is not null. Nulls fit every type; a column of nulls only, or
    of no rows, is a string, as is one whose values have no narrower type in common. White
    space around a number, date or boolean is left out of account. Names may be any that a
    header can hold, repeated ones excepted.
    """
    flags = [F.bool_and(_holds(kind, c)).alias(f"{n}_{k}") for n, c in enumerate(df.columns) for k, kind in enumerate(TEXTS)]
    counts = [F.count(F.col(f"`{c}`")).alias(f"{n}_values") for n, c in enumerate(df.columns)]
    one = df.agg(*flags, *counts)
    rows = []
    for n, name in enumerate(df.columns):
        kind = F.lit(WIDEST)
        for k, narrow in reversed(list(enumerate(TEXTS))):
            kind = F.when(F.col(f"{n}_{k}"), F.lit(narrow)).otherwise(kind)
        rows.append(
            F.struct(
                F.lit(n).alias("position"),
                F.lit(name).alias("column_name"),
                kind.alias("column_type"),
                F.col(f"{n}_values").alias("n_values"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def with_types(df: DataFrame) -> DataFrame:
    """A table of strings with its columns cast to their types. The driver sees one row per
    column."""
    if not df.columns:
        return df
    found = {r["column_name"]: r["column_type"] for r in column_types(df).collect()}
    out = [F.col(f"`{c}`") if found[c] == WIDEST else F.trim(F.col(f"`{c}`")).try_cast(found[c]).alias(c) for c in df.columns]
    return df.select(*out)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder as strings, by header; an empty field is null."""
    return spark.read.option("header", True).option("escape", '"').option("inferSchema", False).csv(path)


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with the column types that all its rows allow. Costs one scan
    more than a declared schema; stage the result where it is read often."""
    return with_types(read_csv_strings(spark, path))
