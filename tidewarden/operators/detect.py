"""Detectors, their vote, and the cold start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import DETECTORS, decisive, deviation, is_true

FLAG_COLUMNS = tuple(f"anomaly_{d}" for d in DETECTORS)
MIN_VOTES = 2


def rule_flag(cfg: EngineConfig) -> Column:
    """The value is far from its baseline."""
    return is_true(decisive(F.abs(deviation(F.col("value"), F.col("baseline")))) > cfg.pct_deviation)


def z_flag(cfg: EngineConfig) -> Column:
    """The z-score is large. It cannot exceed the root of (rows of the frame - 1), so
    with the default frame of 7 rows and threshold 2.5 this detector never fires."""
    return is_true(decisive(F.abs("z")) > cfg.z_threshold)


def iqr_flag() -> Column:
    """The value is outside the interquartile fences."""
    return is_true((F.col("value") < F.col("iqr_lo")) | (F.col("value") > F.col("iqr_hi")))


def votes() -> Column:
    total = F.lit(0)
    for flag in FLAG_COLUMNS:
        total = total + F.col(flag).cast("int")
    return total


def detect_anomalies(long: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Adds a flag per detector and ``anomaly_flag``, the vote of at least two of them.

    Needs the rolling statistics, and with the forest enabled its day-level flag
    ``iforest_raw``. The first rows of a series get no forest flag and no final flag.
    """
    warm = F.col("row_pos") >= cfg.min_rows
    forest = is_true(F.col("iforest_raw")) & warm if cfg.forest_enabled else F.lit(False)
    flagged = long.select(
        *[c for c in long.columns if c != "iforest_raw"],
        rule_flag(cfg).alias("anomaly_rule"),
        z_flag(cfg).alias("anomaly_z"),
        iqr_flag().alias("anomaly_iqr"),
        forest.alias("anomaly_iforest"),
    )
    return flagged.withColumn("anomaly_flag", (votes() >= MIN_VOTES) & warm)
