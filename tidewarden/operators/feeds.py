"""Tables behind dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .alerts import prioritise

TREND_KPIS = ("revenue", "orders")


def trends(long: DataFrame) -> DataFrame:
    """Revenue and order volume with their short and long means."""
    return long.where(F.col("kpi").isin(*TREND_KPIS)).select(
        "series_id", "kpi", "ds", "value", "rolling_mean", "baseline"
    )


def anomaly_distribution(long: DataFrame) -> DataFrame:
    """Days and flagged days of each metric."""
    return long.groupBy("series_id", "kpi").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("anomaly_flag").alias("anomalies")
    )


def severity_distribution(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("series_id", "kpi", "risk_level").agg(F.count(F.lit(1)).alias("alerts"))


def alert_frequency(alerts: DataFrame) -> DataFrame:
    """Alerts per month and risk level."""
    month = F.trunc("ds", "month").alias("month")
    return alerts.groupBy("series_id", month, "risk_level").agg(F.count(F.lit(1)).alias("alerts"))


def incident_log(alerts: DataFrame) -> DataFrame:
    """All alerts in priority order."""
    return prioritise(alerts).select(
        "series_id", "ds", "kpi", "risk_level", "value", "baseline", "z_score", "validation_status", "injected_label"
    )


def root_cause_signals(evidence: DataFrame) -> DataFrame:
    """Evidence structs as rows: one per day, dimension and listed segment."""
    blocks = evidence.select("series_id", "ds", F.col("evidence.primary_kpi").alias("primary_kpi"), F.inline("evidence.evidence"))
    return blocks.select("series_id", "ds", "primary_kpi", "dimension", F.posexplode("top").alias("pos", "driver")).select(
        "series_id", "ds", "primary_kpi", "dimension", (F.col("pos") + 1).alias("rank"), "driver.*"
    )


def breakdown(segments: DataFrame) -> DataFrame:
    """Revenue and delivered orders of each segment per month."""
    month = F.trunc("ds", "month").alias("month")
    return segments.groupBy("series_id", month, "dimension", "segment").agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")
    )
