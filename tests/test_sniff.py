"""Column types of CSV tables, compared with those that DuckDB finds in the same files."""

from __future__ import annotations

import duckdb
import pytest

from tests.test_plans import folder
from tidewarden.sources.sniff import column_types, read_csv_strings, read_csv_typed, with_types

DUCKDB = {"BOOLEAN": "boolean", "BIGINT": "bigint", "HUGEINT": "decimal(38,0)", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string"}
COLUMNS = {
    "id": ["1", "-2", "+3", ""],
    "zip code": ["01037", "90210", "00001", "7"],
    "price": ["1", "2.5", "", "1e3"],
    "big": ["99999999999999999999", "1", "2", "3"],
    "day": ["2018-01-31", "", "2017-12-01", "2018-02-28"],
    "at": ["2018-01-31 10:00:00", "2018-02-01 00:00:00.5", "", "2018-02-01 23:59:59"],
    "no day": ["2018-02-30", "2018-01-01", "2018-01-02", ""],
    "flag": ["true", "FALSE", "", "false"],
    "day or number": ["2018-01-01", "7", "", "8"],
    "word": ["a, b", 'say ""x""', "", "1"],
    "none": ["", "", "", ""],
}


def as_file(rows: list[list[str]], header: list[str]) -> str:
    path = f"{folder()}.csv"
    with open(path, "w") as f:
        for row in (header, *rows):
            f.write(",".join(f'"{v}"' if "," in v or '"' in v else v for v in row) + "\n")
    return path


def kinds(df):
    return {r["column_name"]: r["column_type"] for r in column_types(df).collect()}


def test_types_are_those_of_duckdb(spark):
    path = as_file(list(zip(*COLUMNS.values())), list(COLUMNS))
    got = kinds(read_csv_strings(spark, path))
    said = duckdb.sql(f"DESCRIBE SELECT * FROM read_csv('{path}', header=true, sample_size=-1)").fetchall()
    assert list(got) == list(COLUMNS)
    assert got == {r[0]: DUCKDB[r[1]] for r in said}


def test_days_among_times_are_times(spark):
    # Here the lattice is wider than DuckDB's choice, which is text.
    path = as_file([["2018-01-31"], ["2018-02-01 10:00:00"]], ["at"])
    assert kinds(read_csv_strings(spark, path)) == {"at": "timestamp_ntz"}
    assert [str(r["at"]) for r in read_csv_typed(spark, path).collect()] == ["2018-01-31 00:00:00", "2018-02-01 10:00:00"]


def test_the_last_row_of_many_decides(spark):
    texts = spark.range(200_000, numPartitions=8).selectExpr("CAST(id AS STRING) AS n", "IF(id = 199999, '1.5', '1') AS x", "IF(id = 7, 'x', '1') AS y")
    assert kinds(texts) == {"n": "bigint", "x": "double", "y": "string"}


def test_values_are_cast_and_none_is_lost(spark):
    path = as_file(list(zip(*COLUMNS.values())), list(COLUMNS))
    strings, typed = read_csv_strings(spark, path), read_csv_typed(spark, path)
    assert dict(typed.dtypes) == kinds(strings)
    for before, after in zip(strings.collect(), typed.collect()):
        assert [v is None for v in before] == [v is None for v in after]
    first = typed.first()
    assert (first["big"], first["price"], str(first["day"]), first["flag"], first["word"]) == (99999999999999999999, 1.0, "2018-01-31", True, "a, b")


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_nothing_known_is_text(spark, rows):
    df = spark.createDataFrame(rows, "`a.b` string, c string")
    assert kinds(df) == {"a.b": "string", "c": "string"}
    assert with_types(df).count() == len(rows)
