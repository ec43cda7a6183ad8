"""Series without a name, empty and broken input, stored texts of other makers, zones."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import alerts, d, raw, wide
from tidewarden import EngineConfig, run_pipeline
from tidewarden.functions.columns import detector_count_of_text, detectors_from_text
from tidewarden.functions.message import root_cause_summary_json
from tidewarden.operators.alerts import meaningful_alerts, normalise_alerts
from tidewarden.operators.facts import order_facts
from tidewarden.operators.kpis import kpi_daily
from tidewarden.operators.quality import quality_report
from tidewarden.sources.tables import read_alerts, read_raw, stage_raw, write_table

CONFIG = EngineConfig(z_threshold=2.0, z_low=1.5, z_medium=2.0, z_high=2.3, scenario_enabled=False, forest_trees=10)


def two_states(spark, days=60):
    """The same orders for a state with a name and one without, with a drop near the end."""
    orders, customers, items = [], [("a", "SP"), ("b", None)], []
    for n in range(days):
        for c in ("a", "b"):
            for k in range(1 if n == days - 5 else 4 + n % 3):
                key = f"{c}-{n}-{k}"
                orders.append((key, c, "delivered", f"{d(n + 1)} 10:00:00"))
                items.append((key, "p", 1.0 if n == days - 5 else 100.0 + n % 5, 1.0))
    return raw(spark, orders=orders, customers=customers, items=items)


@pytest.mark.parametrize("forest", [False, True])
def test_a_series_without_a_name_is_searched(spark, tmp_path, forest):
    r = run_pipeline(spark, two_states(spark), str(tmp_path), CONFIG.with_(forest_enabled=forest), "customer_state")
    found = normalise_alerts(read_alerts(spark, r.alerts_path)).collect()
    by_series = {s: sorted((a.ds, a.kpi, a.risk_level) for a in found if a.series_id == s) for s in ("SP", None)}
    assert by_series["SP"] and all(a.validation_status for a in found) and all(a.root_cause_json for a in found)
    assert {a.series_id for a in found} == {"SP", None}
    if not forest:
        assert by_series["SP"] == by_series[None]


def test_empty_input_has_a_clean_report(spark, tmp_path):
    r = run_pipeline(spark, raw(spark), str(tmp_path), CONFIG)
    assert r.status == "OK"
    rows = spark.read.parquet(r.data_quality_report_path).collect()
    assert [tuple(x) for x in rows] == [("all", "PASS", "No issues detected")]


@pytest.mark.parametrize("rows", [[], [(d(1), 1.0, 1.0, 1.0, 0.0)]])
def test_missing_columns_are_reported_without_rows_too(spark, rows):
    got = quality_report(wide(spark, rows).drop("aov")).collect()
    assert [(r.check, r.severity, r.detail) for r in got] == [("schema_required_cols", "FAIL", "Missing: ['aov']")]


def test_each_fault_is_reported(spark):
    rows = [(None, 1.0, 1.0, 1.0, 0.0), (d(1), -1.0, 1.0, 1.0, 0.0), (d(1), 1.0, -2.0, None, 0.0), (d(5), 1.0, 1.0, 1.0, 0.0)]
    got = {(r.check, r.severity, r.detail) for r in quality_report(wide(spark, rows)).collect()}
    assert got == {
        ("ds_nulls", "FAIL", "ds contains nulls"),
        ("ds_duplicates", "FAIL", "1 duplicate dates"),
        ("revenue_negative", "FAIL", "1 days with revenue < 0"),
        ("orders_negative", "FAIL", "1 days with orders < 0"),
        ("null_rate_aov", "WARN", "aov null rate = 25.00%"),
        ("date_gaps", "WARN", "Max gap between dates = 4 days"),
    }


@pytest.mark.parametrize(
    "text, summary",
    [
        ('{"primary_kpi": "aov", "evidence": [{"top": [{"segment": "s", "delta": 1, "pct_contrib": 0.5}]}]}',
         "Primary KPI: aov. unknown_dimension: top driver = s (delta=1.00, contribution=50.0%)"),
        ('{"primary_kpi": "aov", "evidence": [{"dimension": "d", "top": [{}]}]}',
         "Primary KPI: aov. d: top driver = unknown (delta=0.00, contribution=0.0%)"),
        ('{"evidence": [{"dimension": "d", "top": [{"segment": null, "delta": "2", "pct_contrib": "x"}]}]}',
         "Primary KPI: unknown. d: top driver = None (delta=2.00, contribution=N/A)"),
        ('{"primary_kpi": null}', "Primary KPI: None. Root cause evidence present but not easily summarized."),
        ('{"evidence": null}', "Root cause evidence present but could not be parsed."),
        ("{broken", "Root cause evidence present but could not be parsed."),
        ("", "No root cause evidence available."),
    ],
)
def test_summary_of_partial_documents(spark, text, summary):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(root_cause_summary_json(F.col("t"))).first()[0] == summary


@pytest.mark.parametrize(
    "text, count",
    [
        ("{'rule': 1, 'z': 1}", 2),
        ("{'rule': True, 'shape': True}", 2),
        ("{'rule': 0, 'z': '', 'iqr': 0.0, 'other': 'yes'}", 1),
        ("{'rule': False, 'z': None}", 0),
        ("garbage", 0),
        (None, 0),
    ],
)
def test_detectors_count_by_value_and_any_name(spark, text, count):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(detector_count_of_text(F.col("t"))).first()[0] == count
    if text and "shape" in text:
        stored = alerts(spark, [{}]).withColumn("detectors", F.lit(text))
        assert meaningful_alerts(normalise_alerts(stored)).first().detector_count == 2
    if text == "{'rule': 1, 'z': 1}":
        flags = df.select(detectors_from_text(F.col("t")).alias("d")).first().d
        assert (flags.rule, flags.z, flags.iqr) == (True, True, False)


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    tables = raw(
        spark, orders=[("o", "c", "delivered", "2018-01-02 00:30:00")], customers=[("c", "SP")], items=[("o", "p", 1.0, 1.0)]
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        staged = stage_raw(tables, str(tmp_path / "staging"))
        files = {n: f"{n}.csv" for n in ("orders", "customers", "items", "products", "payments")}
        for name, file in files.items():
            write_table(getattr(staged, name), str(tmp_path / file), "csv")
        for zone in ("America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            again = stage_raw(read_raw(spark, str(tmp_path), files), str(tmp_path / "again"))
            facts = order_facts(again)
            assert [str(r.ds) for r in kpi_daily(facts).collect()] == ["2018-01-02"]
            assert facts.first().purchase_ts == datetime(2018, 1, 2, 0, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
