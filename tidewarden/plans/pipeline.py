"""The monitoring job: raw tables to alerts.

Tables that several later steps read are written once and read back: the daily roll-up,
which is the only step that reads the raw tables, the series, and their flags. Lost
executors then cost a retry of a step, not of the run, and no step is computed twice.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import join_same
from ..operators.alerts import build_alerts
from ..operators.bands import ORDER_SEGMENT, cuts_of_sketches, exact_cuts, order_values, value_sketch
from ..operators.baseline import ROLLING_COLUMNS, add_rolling_stats
from ..operators.detect import FLAG_COLUMNS, detect_anomalies
from ..operators.facts import RawTables
from ..operators.iforest import with_forest
from ..operators.kpis import kpi_daily_from_rollup, to_long, to_wide
from ..operators.quality import quality_report, quality_status
from ..operators.risk import classify_risk
from ..operators.rollup import daily_rollup, segment_daily_from_rollup
from ..operators.rootcause import explained_days
from ..operators.scenario import apply_scenarios
from ..sources.tables import Steps, write_table

OK = "OK"
STOPPED = "STOPPED_DATA_QUALITY_FAIL"


@dataclass(frozen=True)
class PipelineResult:
    status: str
    kpi_daily_path: str
    data_quality_report_path: str
    alerts_path: str | None
    features_path: str | None = None
    segments_path: str | None = None


def features(wide: DataFrame, cfg: EngineConfig) -> DataFrame:
    """From daily series to long-form rows with statistics, flags and risk levels."""
    keep = ["injected_label"] if "injected_label" in wide.columns else []
    if cfg.forest_enabled:
        wide = with_forest(wide, cfg)
        keep.append("iforest_raw")
    rolled = add_rolling_stats(to_long(wide, cfg.kpis, keep), cfg)
    return classify_risk(detect_anomalies(rolled, cfg), cfg)


def wide_features(long: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The features with one row per day and columns such as ``revenue_z``."""
    suffix = {
        "rolling_mean": f"rm{cfg.mean_rows}",
        "rolling_std": f"rs{cfg.std_rows}",
        "baseline": f"base{cfg.baseline_rows}",
    }
    columns = {c: suffix.get(c, c) for c in (*ROLLING_COLUMNS, *FLAG_COLUMNS, "anomaly_flag", "risk_level")}
    keep = [c for c in ("injected_label",) if c in long.columns]
    return to_wide(long, cfg.kpis, columns, keep)


def _edge(df: DataFrame, series_col: str | None) -> DataFrame:
    """Without a series column the constant key is left out of what users read."""
    return df if series_col else df.drop("series_id")


def order_cuts(raw: RawTables, cfg: EngineConfig, step: Steps) -> list[float] | None:
    """The values between bands of orders, if the settings ask for that dimension: those
    given, or quantiles of all orders."""
    if ORDER_SEGMENT not in cfg.dimensions:
        return None
    if cfg.order_cuts:
        return sorted(cfg.order_cuts)
    values = step(order_values(raw), "order_values")
    if cfg.order_cuts_exact:
        return exact_cuts(values, cfg.order_bands)
    return cuts_of_sketches(step(value_sketch(values), "order_value_sketch"), cfg.order_bands)


def run_pipeline(
    spark: SparkSession,
    raw: RawTables,
    output_dir: str,
    cfg: EngineConfig | None = None,
    series_col: str | None = None,
    fmt: str = "parquet",
    fanout: str = "faithful",
) -> PipelineResult:
    """Run all steps and write their tables under ``output_dir``.

    A series whose data fail validation is not searched for anomalies; if that leaves
    none, the run stops after the report, which is always written, as are the series.
    ``fmt`` is the format of the tables users read; tables between steps are Parquet.
    """
    cfg = cfg or EngineConfig()
    out = output_dir.rstrip("/")

    step = Steps(f"{out}/_steps")
    # By dimension, so that reading the totals skips the segments.
    daily = daily_rollup(raw, cfg.dimensions, series_col, fanout, order_cuts(raw, cfg, step))
    rollup = step(daily, "rollup", ("dimension",))
    series = step(apply_scenarios(kpi_daily_from_rollup(rollup), cfg), "series")

    report = step(quality_report(series), "quality")
    order = ["series_id", "ds"] if series_col else ["ds"]
    kpi_path = write_table(_edge(series, series_col).orderBy(*order), f"{out}/kpi_daily", fmt)
    report_path = write_table(_edge(report, series_col), f"{out}/data_quality_report", fmt)

    # The gate is observed while the status of each series is written.
    gate, ok = Observation(), F.col("validation_status") != "FAIL"
    status = quality_status(report).observe(gate, F.count(F.lit(1)).alias("series"), F.count_if(ok).alias("passed"))
    passed = step(status, "status").where(ok)
    n = {"series": 0, "passed": 0, **gate.get}
    if n["series"] and not n["passed"]:
        return PipelineResult(STOPPED, kpi_path, report_path, None)

    # The trees of a series are spread over tasks only as far as there are tasks to fill.
    fill = math.ceil(spark.sparkContext.defaultParallelism / max(1, n["passed"]))
    cfg = cfg.with_(forest_blocks=max(1, min(cfg.forest_blocks, fill)))
    checked = join_same(series, passed.select("series_id"), ["series_id"], "left_semi")
    found = step(features(checked, cfg), "features")
    segments = segment_daily_from_rollup(rollup)
    alerts = build_alerts(found, explained_days(found, segments, cfg), passed)
    alerts_path = write_table(_edge(alerts, series_col).orderBy(*order, "kpi"), f"{out}/alerts", fmt)
    return PipelineResult(
        OK, kpi_path, report_path, alerts_path, step.path("features"), step.path("rollup")
    )
