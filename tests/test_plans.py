"""Whole jobs, sources and sinks, and the shape of physical plans."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from catalog.adapter import raw_tables
from catalog.queries import FIXTURE
from tests.helpers import alerts, d, raw, wide
from tests.test_detection import forest_input
from tidewarden import EngineConfig, ScenarioEvent, orchestrate_alerts, run_pipeline
from tidewarden.operators.alerts import NOTIFICATION_COLUMNS, apply_cooldown, meaningful_alerts
from tidewarden.operators.baseline import add_rolling_stats
from tidewarden.operators.iforest import score_forest
from tidewarden.operators.kpis import to_long
from tidewarden.operators.quality import quality_report
from tidewarden.operators.rollup import daily_rollup, segment_daily_from_rollup
from tidewarden.operators.rootcause import contributions
from tidewarden.plans.pipeline import features
from tidewarden.sources.tables import RAW_COLUMNS, RAW_FILES, read_alerts, read_raw, read_table, stage_raw, write_table

SF = "/root/testdata/sf0.001"


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shop(spark, day_total=lambda i: 100.0 + i % 7):
    """Ninety days of one order each, whose price depends on the day."""
    n = range(1, 91)
    return raw(
        spark,
        orders=[(f"o{i}", "c1", "delivered", f"{d(i)} 12:00:00") for i in n],
        customers=[("c1", "SP")],
        items=[(f"o{i}", "p1", day_total(i), 1.0) for i in n],
        products=[("p1", "toys")],
        payments=[(f"o{i}", "card", 1.0) for i in n],
    )


DROP = EngineConfig(
    forest_trees=40,
    scenario_events=(ScenarioEvent("revenue", str(d(70)), 2, 0.3, "Outage"), ScenarioEvent("aov", str(d(70)), 2, 0.3, "Outage")),
)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_both_jobs(spark, fmt):
    out = folder()
    r = run_pipeline(spark, shop(spark), out, DROP, fmt=fmt)
    assert r.status == "OK"
    stored = read_alerts(spark, r.alerts_path, fmt)
    assert "series_id" not in stored.columns
    revenue = stored.where("kpi = 'revenue'").orderBy("ds").collect()
    assert [str(x.ds) for x in revenue][:2] == [str(d(70)), str(d(71))]
    assert {x.risk_level for x in revenue[:2]} == {"HIGH"} and {x.injected_label for x in revenue[:2]} == {"Outage"}
    assert '"dimension":"payment_type"' in revenue[0].root_cause_json

    o = orchestrate_alerts(spark, r.alerts_path, f"{out}/notifications", 3, fmt)
    assert (o.status, o.input_alerts) == ("OK", stored.count())
    assert o.input_alerts >= o.meaningful_alerts >= o.notifications_generated > 0
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).format(fmt)
    written = reader.load(o.output_path)
    assert written.columns == [c for c in NOTIFICATION_COLUMNS if c != "series_id"]
    assert written.count() == o.notifications_generated
    assert "Simulation Tag: Outage" in written.where("kpi = 'revenue'").orderBy("ds").first().message


def test_failing_data_stop_the_job_after_its_report(spark):
    out = folder()
    r = run_pipeline(spark, shop(spark, lambda i: -5.0), out, DROP)
    assert (r.status, r.alerts_path) == ("STOPPED_DATA_QUALITY_FAIL", None)
    assert spark.read.parquet(r.data_quality_report_path).first().check == "revenue_negative"
    assert spark.read.parquet(r.kpi_daily_path).count() == 90


def test_only_failing_series_are_left_out(spark):
    tables = shop(spark)
    bad = raw(
        spark,
        orders=[("x1", "c2", "delivered", "2018-01-01")],
        customers=[("c2", "RJ")],
        items=[("x1", "p1", -50.0, 0.0)],
    )
    both = type(tables)(**{k: getattr(tables, k).union(getattr(bad, k)) for k in RAW_COLUMNS})
    r = run_pipeline(spark, both, folder(), DROP, series_col="customer_state")
    assert r.status == "OK"
    assert {x.series_id for x in spark.read.parquet(r.alerts_path).select("series_id").distinct().collect()} == {"SP"}
    report = spark.read.parquet(r.data_quality_report_path)
    assert {(x.series_id, x.severity) for x in report.collect()} == {("SP", "PASS"), ("RJ", "FAIL")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_no_alerts(spark, fmt):
    out = folder()
    quiet = EngineConfig(forest_enabled=False, scenario_enabled=False, pct_deviation=9.0)
    r = run_pipeline(spark, shop(spark), out, quiet, fmt=fmt)
    o = orchestrate_alerts(spark, r.alerts_path, f"{out}/n", fmt=fmt)
    assert (o.input_alerts, o.meaningful_alerts, o.notifications_generated) == (0, 0, 0)
    assert "message" in spark.read.option("header", True).format(fmt).load(f"{out}/n").columns


def test_missing_alerts_are_an_error(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        orchestrate_alerts(spark, f"{folder()}/none", f"{folder()}/n")


def test_raw_csv_is_read_by_header_and_staged(spark):
    out = folder()
    tables = shop(spark)
    for name, columns in RAW_COLUMNS.items():
        df = getattr(tables, name)
        extra = df.select(F.lit("a,b \"c\"").alias("note"), *reversed(list(columns)))
        write_table(extra, f"{out}/{RAW_FILES[name]}", "csv")
    read = read_raw(spark, out)
    assert dict(read.items.dtypes)["price"] == "double"
    for _ in range(2):
        staged = stage_raw(read, f"{out}/staging")
    assert sorted(map(tuple, staged.items.collect())) == sorted(map(tuple, tables.items.collect()))
    assert staged.orders.where("order_purchase_timestamp IS NULL").count() == 0


def test_tables_keep_their_columns_when_empty(spark):
    df = alerts(spark, [{}]).where("false")
    for fmt in ("csv", "parquet"):
        path = write_table(df, f"{folder()}/t", fmt)
        assert read_alerts(spark, path, fmt).columns == df.columns
    with pytest.raises(ValueError, match="format"):
        write_table(df, f"{folder()}/t", "xlsx")
    path = write_table(wide(spark, [(d(1), 1.0, 1.0, 1.0, 0.0)]), f"{folder()}/t", partition_by=("series_id",))
    assert read_table(spark, path, spark.read.parquet(path).schema).count() == 1


def test_config_from_nested_settings():
    cfg = EngineConfig.from_dict(
        {
            "kpis": ["revenue"],
            "baseline": {"rolling_mean_days": 5, "min_days_for_detection": 9},
            "anomaly_detection": {"iqr_k": 3.0, "isolation_forest": {"enabled": False}},
            "risk": {"z_low": 1.0},
            "root_cause": {"dimensions": ["payment_type"], "lookback_days": 7},
            "anomaly_injection": {"enabled": True, "events": [{"kpi": "revenue", "start_date": "2018-01-01", "days": 1, "multiplier": 2}]},
        }
    )
    assert (cfg.kpis, cfg.mean_rows, cfg.std_rows, cfg.min_rows) == (("revenue",), 5, 7, 9)
    assert (cfg.iqr_k, cfg.forest_enabled, cfg.z_low, cfg.dimensions, cfg.lookback_days) == (3.0, False, 1.0, ("payment_type",), 7)
    assert cfg.scenario_events == (ScenarioEvent("revenue", "2018-01-01", 1, 2.0, "Injected anomaly"),)
    assert not EngineConfig.from_dict({}).scenario_enabled


# --- properties and plans ----------------------------------------------------------


def test_properties_of_the_fixture_run(spark):
    out = folder()
    r = run_pipeline(spark, raw_tables(spark, SF), out, FIXTURE.with_(forest_enabled=True, forest_trees=50))
    long = spark.read.parquet(r.features_path)
    assert long.where("anomaly_flag AND row_pos < 35").count() == 0
    assert long.where("abs(z) > sqrt(6) + 1e-9").count() == 0
    assert long.where("anomaly_flag AND int(anomaly_rule) + int(anomaly_z) + int(anomaly_iqr) + int(anomaly_iforest) < 2").count() == 0
    stored = alerts(spark, []).unionByName(
        spark.read.parquet(r.alerts_path).withColumn("series_id", F.lit("all")).withColumn("root_cause_json", F.lit(None).cast("string"))
    )
    worth = meaningful_alerts(stored)
    kept = {(x.kpi, x.ds) for x in apply_cooldown(worth, 3).collect()}
    for x in worth.collect():
        ages = [(x.ds - y).days for k, y in kept if k == x.kpi]
        if (x.kpi, x.ds) in kept:
            assert not any(0 < abs(a) < 3 for a in ages)
        else:
            assert any(0 < a < 3 for a in ages)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no table is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rollup_plan(spark, no_broadcast):
    text = plan(daily_rollup(raw_tables(spark, SF)))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    # Products and customers each cost their two sides, and nation one more pair; items
    # and payments are reduced and then moved to their order, headers are moved once;
    # the daily groups are the last.
    assert text.count("Exchange hashpartitioning") == 12
    assert "hashpartitioning(order_id" in text
    assert text.count("ReadSchema") == 7


def test_series_plans(spark, no_broadcast):
    series = spark.createDataFrame([], "series_id string, ds date, revenue double, orders double, aov double, payment_fail_rate double")
    rolled = plan(add_rolling_stats(to_long(series), FIXTURE))
    assert rolled.count("Exchange") == 1 and rolled.count("Sort ") == 1
    flags = plan(features(series, FIXTURE))
    assert flags.count("Exchange") == 1 and "Python" not in flags
    report = plan(quality_report(series))
    # The one single partition counts rows, of which each task sends its own number.
    assert report.count("SinglePartition") == 1 and "partial_count(1)" in report
    forest = plan(score_forest(series, FIXTURE))
    assert "SinglePartition" not in forest and "Broadcast" not in forest
    assert forest.count("FlatMapGroupsInPandas") == 1 and "REPARTITION_BY_NUM" in forest


@pytest.mark.parametrize("stored", [False, True])
def test_blocks_of_one_series_run_in_several_tasks_and_once(spark, tmp_path, monkeypatch, stored):
    """By the tasks that the blocks ran in, on a literal and on a stored series."""
    from tidewarden.operators import iforest

    plain, seen = iforest._block_scorer, str(tmp_path / "seen")

    def marking(kpis, cfg):
        score = plain(kpis, cfg)

        def run(pdf):
            from pathlib import Path
            from uuid import uuid4

            from pyspark import TaskContext

            Path(seen).mkdir(exist_ok=True)
            Path(seen, uuid4().hex).write_text(f"{TaskContext.get().partitionId()} {pdf['block'].iloc[0]}")
            return score(pdf)

        return run

    monkeypatch.setattr(iforest, "_block_scorer", marking)
    cfg = EngineConfig(forest_trees=16, forest_blocks=8, forest_tasks=32)
    series = forest_input(spark, 60)
    if stored:
        series.write.parquet(str(tmp_path / "series"))
        series = spark.read.parquet(str(tmp_path / "series"))
    assert score_forest(series, cfg).count() == 60
    marks = [p.read_text().split() for p in (tmp_path / "seen").iterdir()]
    assert sorted(int(b) for _, b in marks) == list(range(8))
    assert len({t for t, _ in marks}) >= 4


def test_root_cause_plan(spark, no_broadcast):
    days = spark.createDataFrame([], "series_id string, ds date, primary_kpi string")
    seg = segment_daily_from_rollup(daily_rollup(raw_tables(spark, SF)))
    text = plan(contributions(days, seg, FIXTURE))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
    assert text.count("WindowGroupLimit") == 2


def test_counts_of_notifications_cost_no_scan(spark, monkeypatch):
    source, out = folder(), folder()
    rows = [{"ds": d(n), "z_score": 3.0} for n in range(1, 21)] + [{"ds": d(n), "kpi": "aov", "risk_level": "LOW", "z_score": 0.1} for n in range(1, 6)]
    alerts(spark, rows).write.mode("overwrite").parquet(source)
    for name in ("count", "first", "collect", "head"):
        monkeypatch.setattr(type(spark.range(1)), name, lambda *_: pytest.fail("an action of its own"))
    r = orchestrate_alerts(spark, source, f"{out}/n", 3)
    monkeypatch.undo()
    assert (r.input_alerts, r.meaningful_alerts, r.notifications_generated) == (25, 20, 7)
    assert spark.read.parquet(f"{out}/n").count() == 7
    none = alerts(spark, [])
    none.write.mode("overwrite").parquet(source)
    r = orchestrate_alerts(spark, source, f"{out}/n", 3)
    assert (r.input_alerts, r.meaningful_alerts, r.notifications_generated) == (0, 0, 0)
