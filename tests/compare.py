"""Compare every registered query with its SQL: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows in a fixed order, missing values alike."""
    out = pd.DataFrame({c: pd.Series([_value(v) for v in df[c]], dtype=object) for c in sorted(df.columns)})
    key = out.apply(lambda row: "\x01".join(map(repr, row)), axis=1) if len(out) else []
    return out.assign(_key=key).sort_values("_key").drop(columns="_key").reset_index(drop=True)


def _value(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v.item() if hasattr(v, "item") else v


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} / {len(sql_df)}"
    a, b = canonical(spark_df), canonical(sql_df)
    for c in a.columns:
        for i, (x, y) in enumerate(zip(a[c], b[c])):
            if x != y or type(x) is not type(y):
                return f"{c}: {x!r} / {y!r}\n{a.iloc[i].to_dict()}\n{b.iloc[i].to_dict()}"
    return None


def main(sf: str, names: list[str]) -> None:
    from tests.conftest import session

    spark = session()
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracle:
                print(f"ROWS {name} {len(got)} {took:.1f}s", flush=True)
                continue
            start = time.time()
            want = con.execute(oracle[name]).df()
            diff = differences(got, want)
            print(f"{'OK  ' if diff is None else 'DIFF'} {name} {len(got)} {took:.1f}s sql {time.time() - start:.1f}s", flush=True)
            if diff:
                print(diff[:1500], flush=True)
        except Exception as e:
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:])
