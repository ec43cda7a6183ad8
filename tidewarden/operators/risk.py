"""Risk level of flagged values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import decisive, deviation


def risk_level(cfg: EngineConfig) -> Column:
    """NONE unless flagged; else by size of the z-score. A flagged revenue far enough
    below its baseline is HIGH whatever its z-score."""
    z = decisive(F.abs("z"))
    big_drop = (F.col("kpi") == "revenue") & (
        decisive(deviation(F.col("value"), F.col("baseline"))) <= -cfg.revenue_drop_pct
    )
    return (
        F.when(~F.col("anomaly_flag"), "NONE")
        .when(big_drop | (z >= cfg.z_high), "HIGH")
        .when(z >= cfg.z_medium, "MEDIUM")
        .when(z >= cfg.z_low, "LOW")
        .otherwise("NONE")
    )


def classify_risk(long: DataFrame, cfg: EngineConfig) -> DataFrame:
    return long.withColumn("risk_level", risk_level(cfg))
