"""What-if overlay: multiply metrics by scenario factors on the days of an event."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig, ScenarioEvent
from ..functions.columns import number

BROADCAST_DAYS = 100_000


def event_days(spark: SparkSession, events: Sequence[ScenarioEvent]) -> DataFrame:
    """One row per day that has events, with all of them in the order they are given."""
    rows = [
        (i, e.kpi, str(e.start_date), int(e.days), float(e.multiplier), e.label)
        for i, e in enumerate(events)
        if e.days > 0
    ]
    schema = "idx int, kpi string, start string, days int, multiplier double, label string"
    start = F.col("start").cast("date")
    days = F.sequence(start, F.date_add(start, F.col("days") - 1), F.expr("interval 1 day"))
    return (
        spark.createDataFrame(rows, schema)
        .select("idx", "kpi", "multiplier", "label", F.explode(days).alias("ds"))
        .groupBy("ds")
        .agg(
            F.sort_array(F.collect_list(F.struct("idx", "kpi", "multiplier", "label"))).alias("events")
        )
    )


def _uniform(digest: Column, start: int) -> Column:
    """A number in (0, 1] from eight hex digits of a digest."""
    return (F.conv(F.substring(digest, start, 8), 16, 10).cast("double") + 1.0) / 4294967296.0


def noise(seed: int, event: Column, scale: float) -> Column:
    """Normal noise around 1 that depends on the seed, event, series and day alone, so
    it is the same however the rows are partitioned (Box-Muller on an md5 digest)."""
    digest = F.md5(
        F.concat_ws("|", F.lit(str(seed)), event.cast("string"), F.col("series_id"), F.date_format("ds", "yyyy-MM-dd"))
    )
    radius = F.sqrt(-2.0 * F.log(_uniform(digest, 1)))
    return 1.0 + scale * radius * F.cos(2.0 * math.pi * _uniform(digest, 9))


def apply_scenarios(wide: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The series with all events applied, and the label of the last event of each day.

    Overlapping events compound. The label belongs to the day, whichever metric its
    event changed; no metric is recomputed from another. Without scenarios, only an
    empty label column is added.
    """
    empty = F.lit(None).cast("string").alias("injected_label")
    if not cfg.scenario_enabled:
        return wide.select("*", empty)
    present = [k for k in cfg.kpis if k in wide.columns]
    others = [c for c in wide.columns if c not in present]
    events = [(i, e) for i, e in enumerate(cfg.scenario_events) if e.kpi in wide.columns]
    if not events:
        return wide.select(*others, *[number(F.col(k)).alias(k) for k in present], empty)

    days = event_days(wide.sparkSession, [e for _, e in events])
    if sum(e.days for _, e in events) <= BROADCAST_DAYS:
        days = F.broadcast(days)
    joined = wide.join(days, "ds", "left")

    def scaled(k: str) -> Column:
        own = F.filter("events", lambda e: e["kpi"] == k)
        value = number(F.col(k))
        if not any(e.kpi == k for _, e in events):
            return value.alias(k)
        changed = F.aggregate(
            own,
            value,
            lambda acc, e: acc * e["multiplier"] * noise(cfg.scenario_seed, e["idx"], cfg.scenario_noise),
        )
        return F.when(F.col("events").isNull(), value).otherwise(changed).alias(k)

    touched = present + [c for c in others if any(e.kpi == c for _, e in events)]
    untouched = [c for c in others if c not in touched]
    label = F.try_element_at("events", F.lit(-1))["label"].alias("injected_label")
    return joined.select(*untouched, *[scaled(k) for k in touched], label)
