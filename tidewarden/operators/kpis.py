"""Daily metric series: from the mart, from the roll-up, and between wide and long form.

Wide form has one row per (series_id, ds) and a column per metric. Long form has one
row per (series_id, kpi, ds), so that one window and one expression serve any number
of metrics and series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_KPIS
from ..functions.columns import number, ratio
from .rollup import TOTAL, series_column

def _metrics(revenue: Column, orders: Column, failed: Column, total: Column) -> list[Column]:
    return [
        revenue.alias("revenue"),
        orders.alias("orders"),
        ratio(revenue, orders).alias("aov"),
        ratio(failed, total).alias("payment_fail_rate"),
    ]


def kpi_daily(facts: DataFrame, series_col: str | None = None) -> DataFrame:
    """Daily metrics of a mart.

    Distinct orders are counted in two steps: one row per (day, order) first, which
    the map side already reduces, then plain counts. A busy day is thus spread over
    its orders, and no row is expanded once per distinct count.
    """
    delivered = F.col("order_status") == "delivered"
    amount = F.col("price") + F.col("freight_value")
    per_order = (
        facts.select(
            series_column(series_col),
            F.col("purchase_date").alias("ds"),
            "order_id",
            F.when(delivered, amount).otherwise(0.0).alias("amount"),
            delivered.alias("delivered"),
            (~delivered).alias("failed"),
        )
        .groupBy("series_id", "ds", "order_id")
        .agg(
            F.sum("amount").alias("amount"),
            F.bool_or("delivered").alias("delivered"),
            F.bool_or("failed").alias("failed"),
        )
    )
    daily = per_order.groupBy("series_id", "ds").agg(
        F.sum("amount").alias("revenue"),
        F.count_if("delivered").alias("orders"),
        F.count_if("failed").alias("failed"),
        F.count("order_id").alias("total"),
    )
    return daily.select("series_id", "ds", *_metrics(*map(F.col, ("revenue", "orders", "failed", "total"))))


def kpi_daily_from_rollup(rollup: DataFrame) -> DataFrame:
    """The same metrics from the total rows of ``daily_rollup``."""
    return rollup.where(F.col("dimension") == TOTAL).select(
        "series_id", "ds", *_metrics(*map(F.col, ("revenue", "orders", "failed", "total")))
    )


def to_long(wide: DataFrame, kpis: Sequence[str] = DEFAULT_KPIS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per metric value; ``keep`` names day-level columns to carry along."""
    doubles = wide.select("series_id", "ds", *keep, *[number(F.col(k)).alias(k) for k in kpis])
    return doubles.unpivot(["series_id", "ds", *keep], list(kpis), "kpi", "value")


def to_wide(
    long: DataFrame,
    kpis: Sequence[str] = DEFAULT_KPIS,
    columns: dict[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Back to one row per day. ``columns`` maps long-form columns to the suffix their
    wide columns get, as in ``revenue_z``; the values themselves get no suffix."""
    columns = columns or {}
    aggs = [F.first("value").alias("value")]
    aggs += [F.first(c).alias(suffix) for c, suffix in columns.items()]
    wide = long.groupBy("series_id", "ds", *keep).pivot("kpi", list(kpis)).agg(*aggs)
    if not columns:
        return wide
    out = [F.col(f"{k}_value").alias(k) for k in kpis]
    out += [F.col(f"{k}_{s}") for k in kpis for s in columns.values()]
    return wide.select("series_id", "ds", *keep, *out)
