"""The daily roll-up kept up to date by signed changes.

A roll-up is a sum over orders, so changed orders change it by the roll-up of their new rows
less that of their old ones. Only these orders are read and joined; only the periods they
touch are read from the store and written again. Each row carries the number of the last
batch added to its period, so a batch that was cut off, or is run again, adds to none twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DIMENSIONS
from ..sources.shared import new_steps
from .facts import RawTables
from .rollup import TOTAL, daily_rollup

KEY = ("series_id", "ds", "dimension", "segment")
COUNTS = ("orders", "failed", "total")
STORED = "series_id string, dimension string, segment string, revenue double, orders bigint, failed bigint, total bigint, ds date, batch bigint, period date"
PERIODS = ("day", "month", "year")
LEAST = 5e-7
"""Revenue below this is what adding doubles in another order leaves of zero."""


def of_orders(raw: RawTables, changed: DataFrame) -> RawTables:
    """The rows of the orders ``changed`` ``(order_id)``."""
    ids = changed.select("order_id").distinct()
    own = {name: getattr(raw, name).join(ids, "order_id", "left_semi") for name in ("orders", "items", "payments")}
    return replace(raw, **own)


def with_changes(raw: RawTables, changes: RawTables, changed: DataFrame) -> RawTables:
    """The inputs with all rows of the orders ``changed`` replaced by those of ``changes``;
    an order that has none there is gone. Customers and products are those of ``raw``."""
    ids = changed.select("order_id").distinct()
    new = of_orders(changes, changed)
    merged = {
        name: getattr(raw, name).join(ids, "order_id", "left_anti").unionByName(getattr(new, name).select(*getattr(raw, name).columns))
        for name in ("orders", "items", "payments")
    }
    return replace(raw, **merged)


def rollup_delta(before: RawTables, after: RawTables, changed: DataFrame, dimensions: Sequence[str] = DEFAULT_DIMENSIONS, **options) -> DataFrame:
    """What changed orders add to each row of the roll-up, or take from it. Rows that stay
    as they are do not occur. ``options`` are those of ``daily_rollup``."""
    new, old = (daily_rollup(of_orders(raw, changed), dimensions, **options) for raw in (after, before))
    minus = old.select(*KEY, *[(-F.col(c)).alias(c) for c in ("revenue", *COUNTS)])
    summed = _summed(new.unionByName(minus))
    moved = F.abs("revenue") >= LEAST
    for c in COUNTS:
        moved = moved | (F.col(c) != 0)
    return summed.where(moved)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(
        F.round(F.sum(F.coalesce("revenue", F.lit(0.0))), 6).alias("revenue"), *[F.sum(c).alias(c) for c in COUNTS]
    )


def _period(unit: str) -> Column:
    if unit not in PERIODS:
        raise ValueError(f"unit must be one of {PERIODS}")
    return (F.col("ds") if unit == "day" else F.trunc("ds", unit)).alias("period")


def _write(rows: DataFrame, path: str, batch: int, mode: str, save: str = "overwrite") -> None:
    """Periods as partitions, in few files each; large ones are split where the adaptive
    rebalancing finds them so."""
    kept = rows.withColumn("batch", F.lit(batch).cast("bigint")).hint("rebalance", "period")
    kept.write.mode(save).option("partitionOverwriteMode", mode).partitionBy("period").parquet(path)


def write_rollup(rollup: DataFrame, path: str, unit: str = "month", save: str = "overwrite") -> None:
    """A roll-up as the store's first state, replacing what is there (``save="ignore"``:
    unless there is one). ``unit`` is the period that is written as a whole: days where a
    day is large, else months or years."""
    _write(_summed(rollup).withColumn("period", _period(unit)), path, 0, "static", save)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The roll-up of a store, as ``daily_rollup`` returns it. Revenue of a segment of which
    no price is known reads zero."""
    return _stored(spark, path).where(_there()).select(*KEY, "revenue", *COUNTS)


def _there() -> Column:
    return (F.col("total") > 0) | (F.col("orders") > 0) | ((F.col("dimension") != TOTAL) & (F.abs("revenue") >= LEAST))


def _among(periods: list) -> Column:
    known = F.coalesce(F.col("period").isin([x for x in periods if x is not None]), F.lit(False))
    return known | F.col("period").isNull() if None in periods else known


def update_rollup(spark: SparkSession, path: str, delta: DataFrame, batch: int, unit: str = "month") -> int:
    """Adds a ``rollup_delta`` to a store and returns the number of periods written.

    ``batch`` numbers the changes upwards, from 1. Periods that already have it, or a later
    one, are left alone, so running a batch again is safe. A period that loses all its
    orders keeps empty totals. The periods, which the calendar bounds, are looked up by the
    driver, so that only their partitions are read. ``unit`` is that of ``write_rollup``.
    """
    step = new_steps(spark, "rollup-delta")
    delta = step(delta.withColumn("period", _period(unit)), "delta")
    touched = [r["period"] for r in delta.select("period").distinct().collect()]
    stored = _stored(spark, path).where(_among(touched))
    done = [r["period"] for r in stored.where(F.col("batch") >= batch).select("period").distinct().collect()]
    open_ = [x for x in touched if x not in done]
    if not open_:
        return 0
    columns = [*KEY, "revenue", *COUNTS]
    both = stored.where(_among(open_)).select(*columns).unionByName(delta.where(_among(open_)).select(*columns))
    merged = _summed(both).where(_there() | (F.col("dimension") == TOTAL)).withColumn("period", _period(unit))
    # By way of a table, as the partitions read are those to be replaced.
    _write(step(merged, "merged"), path, batch, "dynamic")
    return len(open_)
