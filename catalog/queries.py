"""The registered queries: each operator over the whole test tables.

Results are rounded where the order of a sum may show, the same way on both sides of
the comparison. Money is in cents, so series and segment revenue is rounded to cents
before anything is derived from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.config import EngineConfig, ScenarioEvent
from tidewarden.functions.columns import detectors_from_text, detectors_text
from tidewarden.functions.message import EVIDENCE_TYPE, root_cause_summary_json
from tidewarden.operators import alerts as al
from tidewarden.operators import feeds
from tidewarden.operators.bands import ORDER_SEGMENT, band, exact_cuts, order_values, with_order_segment
from tidewarden.operators.baseline import add_rolling_stats, fill_gaps
from tidewarden.operators.facts import RawTables, order_facts
from tidewarden.operators.iforest import fit_forest, score_days, score_forest
from tidewarden.operators.incremental import read_rollup, rollup_delta, update_rollup, write_rollup
from tidewarden.operators.kpis import kpi_daily, kpi_daily_from_rollup, to_long
from tidewarden.operators.quality import quality_report, quality_status
from tidewarden.operators.rollup import daily_rollup, segment_daily, segment_daily_from_rollup
from tidewarden.operators.rootcause import (
    attach_root_cause,
    evidence,
    evidence_json,
    primary_kpi,
    segment_changes,
    top_drivers,
)
from tidewarden.operators.scenario import apply_scenarios
from tidewarden.plans.orchestration import orchestrate_alerts
from tidewarden.plans.pipeline import features, run_pipeline, wide_features
from tidewarden.sources.shared import shared_folder
from tidewarden.sources.sniff import column_types, read_csv_strings
from tidewarden.sources.tables import RAW_COLUMNS, RAW_FILES, Steps, read_alerts, read_raw, stage_raw, write_table
from tidewarden.streaming.cooldown import send_alerts
from tidewarden.streaming.daily import DailyStream, update_daily

from .adapter import raw_tables

# The default z thresholds lie above what a frame of 7 rows can reach; these reach
# every branch.
FIXTURE = EngineConfig(
    z_threshold=2.0,
    z_low=1.5,
    z_medium=2.0,
    z_high=2.3,
    forest_enabled=False,
    scenario_events=(
        ScenarioEvent("revenue", "1998-06-01", 2, 0.60, "Revenue shock (simulated outage)"),
        ScenarioEvent("orders", "1998-03-20", 3, 1.35, "Orders spike (simulated promo)"),
    ),
)
WITH_FOREST = FIXTURE.with_(forest_enabled=True)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _in_cents(wide: DataFrame) -> DataFrame:
    revenue = F.round("revenue", 2)
    return wide.withColumns(
        {"revenue": revenue, "aov": F.try_divide(revenue, F.col("orders").cast("double"))}
    )


def _series(spark: SparkSession, sf: str, by: str | None = None) -> DataFrame:
    return _in_cents(kpi_daily_from_rollup(daily_rollup(raw_tables(spark, sf), (), by)))


def _segments_of(rollup: DataFrame) -> DataFrame:
    return segment_daily_from_rollup(rollup).withColumn("revenue", F.round("revenue", 2))


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segments_of(daily_rollup(raw_tables(spark, sf), FIXTURE.dimensions))


def _features(spark: SparkSession, sf: str, cfg: EngineConfig = FIXTURE) -> DataFrame:
    return features(_series(spark, sf), cfg)


def _steps(spark: SparkSession, sf: str) -> tuple[Steps, DataFrame, DataFrame]:
    """Series and segments from one pass over the raw tables, by way of a table."""
    step = Steps(shared_folder(spark))
    rollup = step(daily_rollup(raw_tables(spark, sf), FIXTURE.dimensions), "rollup", ("dimension",))
    return step, _in_cents(kpi_daily_from_rollup(rollup)), _segments_of(rollup)


def _drivers(days: DataFrame, segments: DataFrame) -> DataFrame:
    return top_drivers(rounded(segment_changes(days, segments, FIXTURE)), FIXTURE)


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with overlay and evidence, by way of the tables the job writes too."""
    step, series, segments = _steps(spark, sf)
    series = step(apply_scenarios(series, FIXTURE), "series")
    long = step(features(series, FIXTURE), "features")
    days = primary_kpi(long, FIXTURE)
    found = evidence(days, _drivers(days, segments), FIXTURE)
    found = found.select("series_id", "ds", evidence_json(F.col("evidence")).alias("root_cause_json"))
    return step(rounded(al.build_alerts(long, found, quality_status(quality_report(series)))), "alerts")


def _shown(alerts: DataFrame) -> DataFrame:
    return rounded(
        alerts.withColumn("detectors", detectors_text(F.col("detectors"))).drop("root_cause_json", "series_id")
    )


# --- mart and series ---------------------------------------------------------------


def q_order_facts(spark: SparkSession, sf: str) -> DataFrame:
    facts = order_facts(raw_tables(spark, sf))
    return facts.withColumn("purchase_ts", F.date_format("purchase_ts", "yyyy-MM-dd HH:mm:ss"))


def q_order_facts_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return (
        order_facts(raw_tables(spark, sf))
        .groupBy("order_status", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("product_category_name").isNull()).alias("no_category"),
            F.round(F.sum(F.col("price") + F.col("freight_value")), 2).alias("amount"),
        )
    )


def q_kpi_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_series(spark, sf)).drop("series_id")


def q_kpi_daily_from_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the row-level mart."""
    return rounded(_in_cents(kpi_daily(order_facts(raw_tables(spark, sf))))).drop("series_id")


def q_kpi_daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the totals of a roll-up that has a dimension too."""
    rollup = daily_rollup(raw_tables(spark, sf), ("customer_state",))
    return rounded(_in_cents(kpi_daily_from_rollup(rollup))).drop("series_id")


def q_kpi_daily_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from tables that arrive in three parts, each a run of the stream: orders
    by their dates; items and payments by order number, so before their order or after."""
    at, whole = shared_folder(spark), raw_tables(spark, sf)
    days = F.to_date("order_purchase_timestamp")
    ends = whole.orders.agg(F.min(days).alias("first"), F.max(days).alias("last")).first()
    third = F.floor(F.datediff(days, F.lit(ends["first"])) * 3 / (F.datediff(F.lit(ends["last"]), F.lit(ends["first"])) + 1))
    parts = {"orders": F.coalesce(third, F.lit(0)), "items": F.col("order_id") % 3, "payments": (F.col("order_id") + 1) % 3}
    to = DailyStream(f"{at}/daily", "year")
    for n in range(3):
        for name, part in parts.items():
            getattr(whole, name).where(part == n).write.mode("append").parquet(f"{at}/{name}")
        arriving = {name: spark.readStream.schema(getattr(whole, name).schema).parquet(f"{at}/{name}") for name in parts}
        update_daily(spark, replace(whole, **arriving), to, keep_days=4000)
    return rounded(_in_cents(kpi_daily_from_rollup(read_rollup(spark, to.rollup)))).drop("series_id")


def q_kpi_daily_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_series(spark, sf, "customer_state"))


def q_kpi_long(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(to_long(_series(spark, sf))).drop("series_id")


def q_raw_csv_to_kpi(spark: SparkSession, sf: str) -> DataFrame:
    raw, folder = raw_tables(spark, sf), shared_folder(spark)
    for name, columns in RAW_COLUMNS.items():
        write_table(getattr(raw, name).select(*columns), f"{folder}/raw/{RAW_FILES[name]}", "csv")
    staged: RawTables = stage_raw(read_raw(spark, f"{folder}/raw"), f"{folder}/staging")
    return rounded(_in_cents(kpi_daily_from_rollup(daily_rollup(staged, ())))).drop("series_id")


def q_raw_csv_types(spark: SparkSession, sf: str) -> DataFrame:
    """The types found in the five inputs as CSV."""
    raw, folder, found = raw_tables(spark, sf), shared_folder(spark), []
    for name, columns in RAW_COLUMNS.items():
        path = write_table(getattr(raw, name).select(*columns), f"{folder}/raw/{RAW_FILES[name]}", "csv")
        types = column_types(read_csv_strings(spark, path)).drop("position")
        found.append(types.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


# --- baselines, detectors, risk ------------------------------------------------------


def _rolled(spark: SparkSession, sf: str) -> DataFrame:
    return add_rolling_stats(to_long(_series(spark, sf)), FIXTURE)


def q_rolling_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_rolled(spark, sf).select("ds", "kpi", "rolling_mean", "rolling_std", "baseline"))


def q_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_rolled(spark, sf).select("ds", "kpi", F.col("row_pos").cast("bigint"), "z"))


def q_iqr_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_rolled(spark, sf).select("ds", "kpi", "iqr_lo", "iqr_hi"), 8)


def q_rolling_stats_by_state(spark: SparkSession, sf: str) -> DataFrame:
    rolled = add_rolling_stats(to_long(_series(spark, sf, "customer_state")), FIXTURE)
    return rounded(rolled.select("series_id", "ds", "kpi", "rolling_mean", "baseline", "z"))


FLAGS = ("anomaly_rule", "anomaly_z", "anomaly_iqr", "anomaly_iforest", "anomaly_flag")


def q_detect_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select("ds", "kpi", *FLAGS)


def q_risk_levels(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select("ds", "kpi", "anomaly_flag", "risk_level")


def q_wide_features(spark: SparkSession, sf: str) -> DataFrame:
    wide = wide_features(_features(spark, sf), FIXTURE).drop("series_id", "injected_label")
    fences = [c for c in wide.columns if "_iqr_" in c]
    return rounded(wide.withColumns({c: F.round(c, 8).cast("decimal(30,8)").cast("string") for c in fences}))


def q_ffill_bfill(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fill_gaps(_series(spark, sf), list(FIXTURE.kpis))).drop("series_id")


def q_iforest_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(score_forest(_series(spark, sf), WITH_FOREST))


def q_iforest_fit_and_score(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a forest that was fitted and stored before."""
    step, series = Steps(shared_folder(spark)), _series(spark, sf)
    forest = step(fit_forest(series, WITH_FOREST), "forest")
    return rounded(score_days(forest, series, WITH_FOREST))


def q_detect_flags_with_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf, WITH_FOREST).select("ds", "kpi", *FLAGS)


# --- quality and scenarios -----------------------------------------------------------


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(_series(spark, sf)).drop("series_id")


def q_quality_report_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(_series(spark, sf, "customer_state"))


def q_quality_status_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return quality_status(quality_report(_series(spark, sf, "customer_state")))


def q_scenario_overlay(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(apply_scenarios(_series(spark, sf), FIXTURE)).drop("series_id")


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    """The series with faults of every kind: a repeated and a missing date, negative
    values and missing ones, in three series so that each status occurs."""
    series = _series(spark, sf)
    at = F.dayofmonth("ds")
    worst = series.withColumns(
        {
            "series_id": F.lit("worst"),
            "ds": F.when(at == 1, None).when(at == 2, F.date_add("ds", 1)).otherwise(F.col("ds")),
            "revenue": F.when(at == 3, -F.col("revenue")).otherwise(F.col("revenue")),
            "orders": F.when(at == 4, -F.col("orders")).otherwise(F.col("orders")),
            "aov": F.when(at < 20, None).otherwise(F.col("aov")),
        }
    )
    gaps = series.where(at < 20).withColumn("series_id", F.lit("gaps"))
    unnamed = series.withColumns({"series_id": F.lit(None).cast("string"), "orders": F.abs("orders")})
    return worst.unionByName(gaps).unionByName(unnamed)


def q_quality_report_damaged(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(_damaged(spark, sf))


def q_quality_status_damaged(spark: SparkSession, sf: str) -> DataFrame:
    return quality_status(quality_report(_damaged(spark, sf)))


# --- root cause ----------------------------------------------------------------------


def q_segment_daily(spark: SparkSession, sf: str) -> DataFrame:
    segments = segment_daily(order_facts(raw_tables(spark, sf)), FIXTURE.dimensions)
    return rounded(segments, 2).drop("series_id")


def q_segment_daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(spark, sf).drop("series_id")


BANDED = FIXTURE.with_(dimensions=(*FIXTURE.dimensions, ORDER_SEGMENT))


def _banded(spark: SparkSession, sf: str) -> DataFrame:
    """Daily segments of all dimensions, the order segment included, by way of a table."""
    raw, step = raw_tables(spark, sf), Steps(shared_folder(spark))
    cuts = exact_cuts(step(order_values(raw), "values"))
    return _segments_of(step(daily_rollup(raw, BANDED.dimensions, order_cuts=cuts), "rollup", ("dimension",)))


def q_order_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of each band of order value."""
    values = Steps(shared_folder(spark))(order_values(raw_tables(spark, sf)), "values")
    banded = values.withColumn("band", band(F.col("value"), exact_cuts(values)))
    return banded.groupBy("band").agg(
        F.count(F.lit(1)).alias("orders"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.sum("value"), 2).alias("amount")
    )


def q_order_segment_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _banded(spark, sf).where(F.col("dimension") == ORDER_SEGMENT).drop("series_id", "dimension")


def q_order_segment_from_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the row-level mart."""
    raw = raw_tables(spark, sf)
    cuts = exact_cuts(Steps(shared_folder(spark))(order_values(raw), "values"))
    segments = segment_daily(with_order_segment(order_facts(raw), raw, cuts), (ORDER_SEGMENT,))
    return rounded(segments, 2).drop("series_id", "dimension")


def q_order_segment_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """Top drivers over four dimensions."""
    days = primary_kpi(_features(spark, sf), FIXTURE)
    changes = rounded(segment_changes(days, _banded(spark, sf), BANDED))
    return rounded(top_drivers(changes, BANDED).drop("series_id"))


def q_order_segment_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feeds.breakdown(_banded(spark, sf)), 2).drop("series_id")


def q_pipeline_order_segment(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job with four dimensions: what its evidence lists for the fourth."""
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), BANDED)
    document = F.from_json("root_cause_json", EVIDENCE_TYPE)
    blocks = read_alerts(spark, r.alerts_path).select("ds", "kpi", F.inline(document["evidence"]))
    return blocks.where(F.col("dimension") == ORDER_SEGMENT).select("ds", "kpi", F.size("top").cast("bigint").alias("listed"))


def q_rollup_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of a roll-up that was made from earlier data and then given the changes:
    orders that came later, others that were delivered after all, and late vouchers."""
    now, path = raw_tables(spark, sf), f"{shared_folder(spark)}/rollup"
    key, status = F.col("order_id"), F.col("order_status")
    flipped = F.when(status == "delivered", "shipped").otherwise("delivered")
    before = replace(
        now,
        orders=now.orders.where(key % 50 != 3).withColumn("order_status", F.when(key % 50 == 7, flipped).otherwise(status)),
        payments=now.payments.where((key % 100 != 0) | (F.col("payment_type") != "voucher")),
    )
    changed = now.orders.where((key % 50).isin(3, 7) | (key % 100 == 0)).select("order_id")
    write_rollup(daily_rollup(before, FIXTURE.dimensions), path)
    update_rollup(spark, path, rollup_delta(before, now, changed, FIXTURE.dimensions), 1)
    return _segments_of(read_rollup(spark, path)).drop("series_id")


def q_primary_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return primary_kpi(_features(spark, sf), FIXTURE).drop("series_id")


def q_segment_changes(spark: SparkSession, sf: str) -> DataFrame:
    _, series, segments = _steps(spark, sf)
    changes = segment_changes(primary_kpi(features(series, FIXTURE), FIXTURE), segments, FIXTURE)
    return rounded(changes.drop("series_id", "unknown_today"))


def q_root_cause_top(spark: SparkSession, sf: str) -> DataFrame:
    _, series, segments = _steps(spark, sf)
    days = primary_kpi(features(series, FIXTURE), FIXTURE)
    return rounded(_drivers(days, segments).drop("series_id"))


def q_root_cause_json(spark: SparkSession, sf: str) -> DataFrame:
    step, series, segments = _steps(spark, sf)
    found = attach_root_cause(step(features(series, FIXTURE), "features"), segments, FIXTURE)
    return _drivers_in(found)


def _drivers_in(found: DataFrame) -> DataFrame:
    """The evidence documents of ``root_cause_json``, one row per driver."""
    document = F.from_json("root_cause_json", EVIDENCE_TYPE)
    blocks = found.where(F.col("root_cause_json").isNotNull()).select(
        "ds", "kpi", document["primary_kpi"].alias("primary_kpi"), F.inline(document["evidence"])
    )
    one = blocks.select("ds", "kpi", "primary_kpi", "dimension", F.posexplode_outer("top").alias("rank", "top"))
    return rounded(
        one.select(
            "ds", "kpi", "primary_kpi", "dimension", (F.col("rank") + 1).alias("rank"), "top.segment",
            "top.today", "top.baseline", "top.delta", "top.pct_contrib",
        )
    )


# --- alerts --------------------------------------------------------------------------


def q_alert_table(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_alerts(spark, sf))


def q_meaningful_alerts(spark: SparkSession, sf: str) -> DataFrame:
    kept = al.meaningful_alerts(_alerts(spark, sf))
    return rounded(kept.select("ds", "kpi", "risk_level", "z_score", "detector_count"))


def q_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    sent = al.apply_cooldown(al.meaningful_alerts(_alerts(spark, sf)), FIXTURE.cooldown_days)
    return rounded(sent.select("ds", "kpi", "risk_level", "z_score"))


def q_cooldown_long(spark: SparkSession, sf: str) -> DataFrame:
    """The same by jumps from date to date, without a row that holds them all."""
    step = Steps(shared_folder(spark))
    sent = al.apply_cooldown(step(al.meaningful_alerts(_alerts(spark, sf)), "alerts"), FIXTURE.cooldown_days, long_histories=True)
    return rounded(sent.select("ds", "kpi", "risk_level", "z_score"))


def q_cooldown_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from alerts that arrive in three parts, each a run of the stream."""
    folder, found = shared_folder(spark), al.meaningful_alerts(_alerts(spark, sf))
    days = found.agg(F.min("ds").alias("first"), F.max("ds").alias("last")).first()
    third = F.floor(F.datediff("ds", F.lit(days["first"])) * 3 / (F.datediff(F.lit(days["last"]), F.lit(days["first"])) + 1))
    for n in range(3):
        found.where(third == n).write.mode("append").parquet(f"{folder}/alerts")
        stream = spark.readStream.schema(found.schema).parquet(f"{folder}/alerts")
        send_alerts(stream, f"{folder}/sent", f"{folder}/checkpoint", FIXTURE.cooldown_days)
    sent = spark.read.schema(found.schema).parquet(f"{folder}/sent")
    return rounded(sent.select("ds", "kpi", "risk_level", "z_score"))


def q_notifications_ranked(spark: SparkSession, sf: str) -> DataFrame:
    sent = al.apply_cooldown(al.meaningful_alerts(_alerts(spark, sf)), FIXTURE.cooldown_days)
    return rounded(al.prioritise(sent).select("ds", "kpi", "risk_rank", "abs_z", "detector_count"))


def q_messages(spark: SparkSession, sf: str) -> DataFrame:
    return al.notifications(_alerts(spark, sf), FIXTURE).select("ds", "kpi", "message")


def q_detectors_text(spark: SparkSession, sf: str) -> DataFrame:
    """The flags of every alert, stored as text and read back."""
    text = _alerts(spark, sf).select("ds", "kpi", detectors_text(F.col("detectors")).alias("text"))
    return text.select("ds", "kpi", "text", detectors_from_text(F.col("text")).alias("d")).select(
        "ds", "kpi", "text", "d.rule", "d.z", "d.iqr", "d.iforest"
    )


def q_alerts_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = write_table(_alerts(spark, sf), f"{shared_folder(spark)}/alerts", "csv")
    return _shown(al.normalise_alerts(read_alerts(spark, path, "csv")).drop("detector_count"))


def q_orchestration_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    path = write_table(_alerts(spark, sf), f"{folder}/alerts")
    r = orchestrate_alerts(spark, path, f"{folder}/notifications", FIXTURE.cooldown_days)
    return spark.read.parquet(r.output_path).agg(
        F.lit(r.input_alerts).cast("bigint").alias("input_alerts"),
        F.lit(r.meaningful_alerts).cast("bigint").alias("meaningful_alerts"),
        F.count(F.lit(1)).alias("notifications"),
    )


def q_pipeline_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job without the forest."""
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), FIXTURE)
    return _shown(al.normalise_alerts(read_alerts(spark, r.alerts_path)).drop("detector_count"))


def q_pipeline_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """The evidence that the job writes with its alerts."""
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), FIXTURE)
    found = read_alerts(spark, r.alerts_path)
    drivers = _drivers_in(found)
    return drivers.groupBy("ds", "kpi", "primary_kpi", "dimension").agg(
        F.count("rank").alias("listed"), F.max(F.abs("delta")).alias("largest")
    )


def q_pipeline_kpi_daily(spark: SparkSession, sf: str) -> DataFrame:
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), FIXTURE)
    kpis = spark.read.parquet(r.kpi_daily_path)
    return kpis.select("ds", *[F.round(k, 2).alias(k) for k in ("revenue", "orders")], "injected_label")


def q_pipeline_quality(spark: SparkSession, sf: str) -> DataFrame:
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), FIXTURE)
    return spark.read.parquet(r.data_quality_report_path)


def q_pipeline_alerts_unnamed_series(spark: SparkSession, sf: str) -> DataFrame:
    """The job by state, where one state has no name: that series is searched too."""
    raw = raw_tables(spark, sf)
    state = F.col("customer_state")
    customers = raw.customers.withColumn("customer_state", F.when(state > "M", None).otherwise(F.lit("A to M")))
    r = run_pipeline(spark, replace(raw, customers=customers), shared_folder(spark), FIXTURE, "customer_state")
    stored = al.normalise_alerts(read_alerts(spark, r.alerts_path))
    explained = F.col("root_cause_json").isNotNull().alias("explained")
    return rounded(stored.select("series_id", "ds", "kpi", "value", "risk_level", "validation_status", explained))


def q_orchestration_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The notifications that the second job writes."""
    folder = shared_folder(spark)
    path = write_table(_alerts(spark, sf), f"{folder}/alerts")
    r = orchestrate_alerts(spark, path, f"{folder}/notifications", FIXTURE.cooldown_days)
    return spark.read.parquet(r.output_path).select("ds", "kpi", "risk_level", "message")


def q_summaries_of_partial_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of evidence documents that lack parts or hold nulls."""
    n = F.dayofmonth("ds") % 6
    number = F.round("revenue", 2).cast("decimal(20,2)").cast("string")
    text = (
        F.when(n == 0, F.concat(F.lit('{"evidence": [{"top": [{"delta": '), number, F.lit("}]}]}")))
        .when(n == 1, F.concat(F.lit('{"primary_kpi": "aov", "evidence": [{"dimension": "d", "top": [{"segment": null, "delta": "'), number, F.lit('", "pct_contrib": null}]}]}')))
        .when(n == 2, '{"primary_kpi": null, "evidence": [{"dimension": "d", "top": []}]}')
        .when(n == 3, '{"primary_kpi": "aov"}')
        .when(n == 4, "[1, 2")
        .otherwise("")
    )
    return _series(spark, sf).select("ds", root_cause_summary_json(text).alias("summary"))


def q_pipeline_alerts_with_forest(spark: SparkSession, sf: str) -> DataFrame:
    r = run_pipeline(spark, raw_tables(spark, sf), shared_folder(spark), WITH_FOREST)
    return _shown(al.normalise_alerts(read_alerts(spark, r.alerts_path)).drop("detector_count"))


# --- feeds ---------------------------------------------------------------------------


def q_feed_trends(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feeds.trends(_features(spark, sf))).drop("series_id")


def q_feed_anomaly_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.anomaly_distribution(_features(spark, sf)).drop("series_id")


def q_feed_severity(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.severity_distribution(_alerts(spark, sf)).drop("series_id")


def q_feed_alert_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.alert_frequency(_alerts(spark, sf)).drop("series_id")


def q_feed_incident_log(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feeds.incident_log(_alerts(spark, sf))).drop("series_id")


def q_feed_root_cause_signals(spark: SparkSession, sf: str) -> DataFrame:
    step, series, segments = _steps(spark, sf)
    days = step(primary_kpi(features(series, FIXTURE), FIXTURE), "days")
    signals = feeds.root_cause_signals(evidence(days, _drivers(days, segments), FIXTURE))
    return rounded(signals).drop("series_id")


def q_feed_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feeds.breakdown(_segments(spark, sf)), 2).drop("series_id")


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
