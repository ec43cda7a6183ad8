"""The notification job: alerts to ranked messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators.alerts import meaningful_alerts, normalise_alerts, notifications
from ..sources.tables import Steps, read_alerts, write_table


@dataclass(frozen=True)
class OrchestrationResult:
    status: str
    input_alerts: int
    meaningful_alerts: int
    notifications_generated: int
    output_path: str


def orchestrate_alerts(
    spark: SparkSession,
    alerts_path: str,
    output_path: str,
    cooldown_days: int = 3,
    fmt: str = "parquet",
    alerts_fmt: str | None = None,
) -> OrchestrationResult:
    """Read alerts, write the notifications worth sending, and count both.

    Alerts are read once: those worth sending are written beside the output first. All
    counts are observed while tables are written.
    """
    stored = read_alerts(spark, alerts_path, alerts_fmt or fmt)
    read, meaningful, sent = Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    worth = meaningful_alerts(normalise_alerts(stored).observe(read, n)).observe(meaningful, n)
    kept = Steps(f"{output_path.rstrip('/')}_steps")(worth, "meaningful")

    result = notifications(kept, EngineConfig(cooldown_days=cooldown_days))
    if "series_id" not in stored.columns:
        result = result.drop("series_id")
    write_table(result.observe(sent, n), output_path, fmt)
    # Where a plan turned out empty before it ran, there is nothing to observe.
    counts = [seen.get.get("n", 0) for seen in (read, meaningful, sent)]
    return OrchestrationResult("OK", *counts, output_path)
