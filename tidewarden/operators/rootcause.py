"""Which segments drove the change of a flagged day.

All flagged days and dimensions are explained in one plan: each day is laid on the calendar
of each segment of its series, where a window by date reads its lookback, rather than by a
range join, a join per date or a query per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import join_same, risk_rank
from ..functions.message import EVIDENCE_TYPE

# Segments that enter the total, segments listed, total used for 0.
CUT = 50
LISTED = 5
ZERO_TOTAL = 1e-9
SALTS = 32


def primary_kpi(long: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The metric to explain on each day with any flag, as ``(series_id, ds,
    primary_kpi)``: highest risk, then largest z-score, then first in the settings.
    Metrics without a flag compete too."""
    first = F.lit(len(cfg.kpis))
    for i, k in enumerate(cfg.kpis):
        first = F.when(F.col("kpi") == k, i).otherwise(first)
    order = F.struct(
        risk_rank(F.col("risk_level")).alias("risk"),
        F.coalesce(F.abs("z"), F.lit(-1.0)).alias("z"),
        (-first).alias("first"),
    )
    return (
        long.groupBy("series_id", "ds")
        .agg(F.bool_or("anomaly_flag").alias("flagged"), F.max_by("kpi", order).alias("primary_kpi"))
        .where("flagged")
        .drop("flagged")
    )


def flagged_segments(days: DataFrame, segments: DataFrame) -> DataFrame:
    """Each flagged day with each segment of its series: ``(series_id, dimension, segment,
    ds, primary_kpi)``. A series brings its flagged days, which the calendar bounds, to its
    segments in ``SALTS`` copies, so that those of one long series meet in many tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    dated = days.where(F.col("ds").isNotNull())
    listed = dated.groupBy("series_id").agg(F.collect_list(F.struct("ds", "primary_kpi")).alias("flagged"))
    key = ["series_id", "dimension", "segment"]
    salt = F.pmod(F.xxhash64("dimension", "segment"), F.lit(SALTS)).cast("int").alias("salt")
    named = segments.select(*key).distinct().select("*", salt)
    met = join_same(named, listed.select("*", salts), ["series_id", "salt"])
    return met.select(*key, F.inline("flagged"))


def segment_changes(days: DataFrame, segments: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Today's metric of each segment against its mean over the lookback.

    The metric is revenue where revenue is the primary metric, else delivered orders.
    The mean covers the days a segment appears on. Segments of either side appear; the
    unknown segment of today and that of the lookback do not match each other.

    Flagged days meet the segments of their series, not their dates: one row per flagged
    day and segment is laid on the segment's own days, and a window by date reads the
    lookback there. So what is shuffled is a row per segment-day and one per flagged day
    and segment, however long the lookback, and a partition is the calendar of a segment.
    """
    key = ["series_id", "dimension", "segment"]
    measures = {"revenue": F.col("revenue"), "orders": F.col("orders").cast("double")}
    known = segments.where(F.col("ds").isNotNull()).select(*key, "ds", *[c.alias(m) for m, c in measures.items()])
    asked = flagged_segments(days, segments)
    none = [F.lit(None).cast("double").alias(m) for m in measures]
    laid = known.select("*", F.lit(None).cast("string").alias("primary_kpi"), F.lit(False).alias("asked"))
    laid = laid.unionByName(asked.select(*key, "ds", *none, "primary_kpi", F.lit(True).alias("asked")))
    by_date = Window.partitionBy(*key).orderBy(F.unix_date("ds").cast("bigint"))
    today, before = by_date.rangeBetween(0, 0), by_date.rangeBetween(-cfg.lookback_days, -1)
    of = lambda frame, fn: F.struct(*[fn(m).over(frame).alias(m) for m in measures])
    appears = F.count(F.when(~F.col("asked"), 1))
    read = laid.select(
        *key, "ds", "primary_kpi", "asked",
        of(today, F.sum).alias("t"), of(before, F.avg).alias("b"),
        appears.over(today).alias("on"), appears.over(before).alias("earlier"),
    ).where("asked")
    pick = lambda side: F.coalesce(F.when(F.col("primary_kpi") == "revenue", F.col(f"{side}.revenue")).otherwise(F.col(f"{side}.orders")), F.lit(0.0))
    zero, unknown = F.lit(0.0), F.col("segment").isNull()
    side = lambda mark, t, b: F.struct(mark.alias("unknown_today"), t.alias("today"), b.alias("baseline"))
    both = F.array(side(F.lit(None).cast("boolean"), pick("t"), pick("b")))
    apart = F.filter(
        F.array(
            F.when(F.col("on") > 0, side(F.lit(True), pick("t"), zero)),
            F.when(F.col("earlier") > 0, side(F.lit(False), zero, pick("b"))),
        ),
        lambda x: x.isNotNull(),
    )
    found = read.where((F.col("on") > 0) | (F.col("earlier") > 0)).select(
        "series_id", F.col("ds").alias("anomaly_ds"), "dimension", "segment", F.inline(F.when(unknown, apart).otherwise(both))
    )
    return found.withColumn("delta", F.col("today") - F.col("baseline"))


def top_drivers(changes: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The largest changes of each day and dimension, with their share of the total.

    The total is taken over the 50 largest. Tasks keep only their own 50 best before
    the shuffle, however many segments a dimension has.
    """
    group = Window.partitionBy("series_id", "anomaly_ds", "dimension")
    by_size = group.orderBy(
        F.desc(F.abs("delta")), F.asc_nulls_last("segment"), F.desc_nulls_first("unknown_today")
    )
    total = F.sum("delta").over(by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    nonzero = F.when(total == 0, F.lit(ZERO_TOTAL)).otherwise(total)
    return (
        changes.withColumn("rank", F.row_number().over(by_size))
        .where(F.col("rank") <= CUT)
        .withColumn("pct_contrib", F.try_divide(F.col("delta"), nonzero))
        .where(F.col("rank") <= min(LISTED, cfg.top_n))
        .select("series_id", "anomaly_ds", "dimension", "rank", "segment", "today", "baseline", "delta", "pct_contrib")
    )


def contributions(days: DataFrame, segments: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Top drivers of flagged days: one row per (day, dimension, rank)."""
    return top_drivers(segment_changes(days, segments, cfg), cfg)


def evidence(days: DataFrame, drivers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One evidence struct per flagged day, as ``(series_id, ds, evidence)``; every
    dimension of the settings is in it, with an empty list where nothing is known.
    ``drivers`` are the ``contributions`` of these days."""
    listed = drivers.groupBy("series_id", F.col("anomaly_ds").alias("ds")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "dimension",
                    "rank",
                    F.struct("segment", "today", "baseline", "delta", "pct_contrib").alias("driver"),
                )
            )
        ).alias("drivers")
    )

    def block(dimension: str) -> Column:
        own = F.filter(F.coalesce("drivers", F.array()), lambda d: d["dimension"] == dimension)
        return F.struct(
            F.lit(dimension).alias("dimension"),
            F.transform(own, lambda d: d["driver"]).alias("top"),
        )

    document = F.struct(
        F.col("primary_kpi"), F.array(*[block(d) for d in cfg.dimensions]).alias("evidence")
    ).cast(EVIDENCE_TYPE)
    return join_same(days, listed, ["series_id", "ds"], "left").select(
        "series_id", "ds", document.alias("evidence")
    )


def evidence_json(document: Column) -> Column:
    """Evidence as JSON text, unknown segments included."""
    return F.to_json(document, {"ignoreNullFields": "false"})


def explained_days(long: DataFrame, segments: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Evidence of each flagged day, as struct and as JSON text ``root_cause_json``."""
    days = primary_kpi(long, cfg)
    found = evidence(days, contributions(days, segments, cfg), cfg)
    return found.withColumn("root_cause_json", evidence_json(F.col("evidence")))


def attach_root_cause(long: DataFrame, segments: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Adds ``root_cause_json`` to the rows of flagged days."""
    found = explained_days(long, segments, cfg).drop("evidence")
    return join_same(long, found, ["series_id", "ds"], "left")
