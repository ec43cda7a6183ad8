"""Daily series on streams of orders, items and payments."""

from __future__ import annotations

import random
from dataclasses import fields
from pathlib import Path

import pytest

from tests.helpers import SCHEMAS, d, raw
from tests.test_plans import folder
from tidewarden.operators.facts import RawTables, order_facts
from tidewarden.operators.incremental import read_rollup
from tidewarden.operators.kpis import kpi_daily, kpi_daily_from_rollup
from tidewarden.streaming.daily import DailyStream, late_rows, update_daily

CUSTOMERS = [("c1", "SP"), ("c2", "RJ"), ("c3", None)]
PRODUCTS = [("p1", "toys"), ("p2", None)]


def streams(spark, at: str, files: int = 1) -> RawTables:
    def table(name):
        if name == "customers":
            return spark.createDataFrame(CUSTOMERS, SCHEMAS[name])
        if name == "products":
            return spark.createDataFrame(PRODUCTS, SCHEMAS[name])
        return spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files).parquet(f"{at}/{name}")

    return RawTables(**{f.name: table(f.name) for f in fields(RawTables)})


def arrive(spark, at: str, **tables) -> None:
    for name in ("orders", "items", "payments"):
        rows = spark.createDataFrame(tables.get(name, []), SCHEMAS[name]).coalesce(1)
        rows.write.mode("append").parquet(f"{at}/{name}")


def series(df):
    return sorted(
        (str(r["series_id"]), str(r["ds"]), round(r["revenue"], 2), r["orders"], None if r["aov"] is None else round(r["aov"], 4), r["payment_fail_rate"] and round(r["payment_fail_rate"], 9))
        for r in df.collect()
    )


def shop(rng: random.Random, n: int) -> dict[str, list[tuple]]:
    """Orders on three days; some listed twice, without date, items, payments or a known
    customer, some paid several times; items of unknown price and products."""
    orders, items, payments = [], [], []
    for i in range(n):
        key = None if i % 41 == 40 else f"o{i}"
        for _ in range(1 + (i % 13 == 0)):
            day = None if i % 17 == 16 else f"{d(rng.randint(1, 3))} 12:00:00"
            orders.append((key, rng.choice(["c1", "c2", "c3", "none"]), rng.choice(["delivered", "delivered", "canceled", None]), day))
        items += [(key, rng.choice(["p1", "p9"]), rng.choice([None, 10.0, 7.25]), 0.5) for _ in range(rng.randint(0, 3))]
        payments += [(key, "card", 1.0) for _ in range(rng.randint(0, 3))]
    items += [("o1", "p1", 1.0, 0.25)] * 200
    return {"orders": orders, "items": items, "payments": payments}


@pytest.mark.parametrize(("seed", "series_col", "fanout"), [(1, None, "faithful"), (2, "customer_state", "faithful"), (3, None, "dedup")])
def test_any_split_gives_the_batch_series(spark, seed, series_col, fanout):
    rng, at, to = random.Random(seed), folder(), DailyStream(folder(), "day")
    tables = shop(rng, 60)
    parts = [{k: [] for k in tables} for _ in range(5)]
    for name, rows in tables.items():
        for r in rows:
            rng.choice(parts)[name].append(r)
    for n, part in enumerate(parts):
        arrive(spark, at, **part)
        if n in (1, 2, 4):
            # Each call is a restart from the checkpoint; the first meets two files.
            update_daily(spark, streams(spark, at), to, series_col=series_col, fanout=fanout)
    whole = raw(spark, customers=CUSTOMERS, products=PRODUCTS, **tables)
    want = series(kpi_daily(order_facts(whole, fanout), series_col))
    assert series(kpi_daily_from_rollup(read_rollup(spark, to.rollup))) == want
    assert late_rows(spark, to).count() == 0
    update_daily(spark, streams(spark, at), to, series_col=series_col, fanout=fanout)
    assert series(kpi_daily_from_rollup(read_rollup(spark, to.rollup))) == want


def order(key, day, status="delivered"):
    return (key, "c1", status, f"{d(day)} 00:00:00")


def test_late_rows_are_counted_and_add_nothing(spark):
    at, to = folder(), DailyStream(folder(), "day")
    steps = [
        {"orders": [order("a", 10)], "items": [("a", "p1", 10.0, 0.0)]},
        # An item and payments that never get their order wait, then count as late.
        {"orders": [order("b", 20)], "items": [("b", "p1", 20.0, 0.0), ("x", "p1", 1.0, 0.0)], "payments": [("x", "card", 1.0)] * 2},
        # Ordered before the watermark (day 20 less 7).
        {"orders": [order("late", 12), order("intime", 14)], "items": [("late", "p1", 5.0, 0.0), ("intime", "p1", 7.0, 0.0)]},
        {"orders": [order("c", 60)], "items": [("c", "p1", 30.0, 0.0)]},
        # The state of the first is gone: a second payment of it is late in the end.
        {"payments": [("a", "card", 1.0), ("c", "card", 1.0), ("c", "card", 1.0)]},
        {"orders": [order("d", 120)], "items": [("d", "p1", 40.0, 0.0)]},
        {"orders": [order("e", 121)], "items": [("e", "p1", 50.0, 0.0)]},
    ]
    for step in steps:
        arrive(spark, at, **step)
        update_daily(spark, streams(spark, at), to, late_days=7, keep_days=10)
    got = {str(r["ds"]): r["revenue"] for r in kpi_daily_from_rollup(read_rollup(spark, to.rollup)).collect()}
    assert got == {str(d(n)): v for n, v in ((10, 10.0), (14, 7.0), (20, 20.0), (60, 60.0), (120, 40.0), (121, 50.0))}
    late = {(r["late"], r["ds"]): r["n"] for r in late_rows(spark, to).collect()}
    assert late == {("header", d(12)): 1, ("item", None): 2, ("payment", None): 3}


def test_nothing_arrives(spark):
    at, to = folder(), DailyStream(folder())
    arrive(spark, at)
    update_daily(spark, streams(spark, at), to)
    assert read_rollup(spark, to.rollup).count() == 0 and late_rows(spark, to).count() == 0


def test_no_python_runs_per_order_and_a_batch_run_again_adds_nothing(spark, monkeypatch):
    """A Python call per order of each batch took hours on a million orders."""

    def refused(*args, **options):
        raise AssertionError("rows of a stream go through Python")

    monkeypatch.setattr("pyspark.sql.DataFrame.mapInPandas", refused)
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandasWithState", refused)
    at, to = folder(), DailyStream(folder(), "day")
    steps = [
        {"orders": [order("a", 10), order("a", 10), order("a", 11)], "items": [("a", "p1", 10.0, 0.0)]},
        {"orders": [order("a", 10), order("b", 12)], "items": [("b", "p1", 20.0, 0.0), ("x", "p1", 1.0, 0.0)]},
        {"orders": [order("late", 1), order("c", 60)], "items": [("late", "p1", 5.0, 0.0)], "payments": [("b", "card", 1.0)] * 2},
    ]
    for step in steps:
        arrive(spark, at, **step)
        update_daily(spark, streams(spark, at), to)

    def found():
        got = {str(r["ds"]): (r["revenue"], r["orders"]) for r in kpi_daily_from_rollup(read_rollup(spark, to.rollup)).collect()}
        return got, {(r["late"], r["ds"]): r["n"] for r in late_rows(spark, to).collect()}

    want = {str(d(10)): (30.0, 1), str(d(11)): (10.0, 1), str(d(12)): (40.0, 1)}, {("header", d(1)): 1, ("item", None): 2}
    assert found() == want
    # As if the run had been cut off before its last batch was marked as done.
    commits = Path(to.checkpoint) / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    update_daily(spark, streams(spark, at), to)
    assert found() == want
