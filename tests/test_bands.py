"""Bands of order value, and the lookback that reads them."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import d, raw
from tests.test_plans import shop, folder
from tidewarden import EngineConfig, run_pipeline
from tidewarden.operators.bands import ORDER_SEGMENT, band, cuts_of_sketches, exact_cuts, order_values, value_sketch
from tidewarden.operators.rollup import daily_rollup
from tidewarden.operators.rootcause import flagged_segments, segment_changes
from tidewarden.sources.tables import read_alerts


def table(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "order_id string, value double")


def plain_cuts(values, bands):
    known = sorted(v for v in values if v is not None)
    return [known[math.ceil(len(known) * i / bands) - 1] for i in range(1, bands)] if known else []


@pytest.mark.parametrize("bands", [1, 2, 4, 7])
def test_exact_cuts_equal_sorted_values(spark, bands):
    rng = np.random.default_rng(bands)
    for values in (
        [*np.round(rng.lognormal(3, 2, 500), 2).tolist(), None, None],
        [5.0] * 90 + [1.0, 9.0],
        [-1e308, 1e308, 0.0, 1e-300, -1e-300],
        [1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0)] * 5,
        [7.0],
    ):
        assert exact_cuts(table(spark, values), bands, bins=8) == plain_cuts(values, bands)
    assert exact_cuts(table(spark, [None, None]), bands) == []


def test_sketches_merge_and_their_ranks_are_near(spark):
    values = np.random.default_rng(1).lognormal(3, 2, 40_000).tolist()
    df = table(spark, values).withColumn("ds", F.pmod(F.xxhash64("order_id"), F.lit(20)))
    daily = value_sketch(df, ["ds"])
    assert daily.count() == 20
    ordered = np.sort(values)
    for cuts in (cuts_of_sketches(daily), cuts_of_sketches(value_sketch(df))):
        ranks = np.searchsorted(ordered, cuts, side="right") / len(values)
        assert np.abs(ranks - [0.25, 0.5, 0.75]).max() < 0.01
    assert cuts_of_sketches(value_sketch(df.limit(0))) == []


def test_bands_of_values_on_a_cut_and_of_none(spark):
    got = table(spark, [1.0, 2.0, 2.5, 3.0, 9.0, None]).select(band(F.col("value"), [2.0, 3.0]).alias("b"))
    assert [r["b"] for r in got.collect()] == ["1 of 3", "1 of 3", "2 of 3", "2 of 3", "3 of 3", None]
    assert table(spark, [1.0]).select(band(F.col("value"), []).alias("b")).first()["b"] == "1 of 1"


def orders(spark):
    """Two payments of one order, an order of two items, and one whose price is unknown."""
    return raw(
        spark,
        orders=[(f"o{i}", "c1", "delivered", f"{d(1)} 10:00:00") for i in (1, 2, 3)],
        customers=[("c1", "SP")],
        items=[("o1", "p1", 10.0, 1.0), ("o2", "p1", 20.0, 0.0), ("o2", "p2", 30.0, 0.0), ("o3", "p1", None, 1.0)],
        products=[("p1", "toys")],
        payments=[("o1", "card", 1.0), ("o1", "voucher", 1.0), ("o2", "card", 1.0)],
    )


def test_segment_of_an_order_counts_its_items_once_per_payment(spark):
    assert dict(order_values(orders(spark)).collect()) == {"o1": 11.0, "o2": 50.0, "o3": None}
    rows = daily_rollup(orders(spark), (ORDER_SEGMENT, "payment_type"), order_cuts=[11.0]).where(F.col("dimension") == ORDER_SEGMENT)
    got = {r["segment"]: (r["revenue"], r["orders"]) for r in rows.collect()}
    assert got == {"1 of 2": (22.0, 1), "2 of 2": (50.0, 1), None: (None, 1)} or got == {"1 of 2": (22.0, 1), "2 of 2": (50.0, 1), None: (0.0, 1)}
    with pytest.raises(ValueError):
        daily_rollup(orders(spark), (ORDER_SEGMENT,))


@pytest.mark.parametrize("exact", [True, False])
def test_the_job_explains_by_order_segment(spark, exact):
    cfg = EngineConfig.from_dict({"root_cause": {"dimensions": [ORDER_SEGMENT], "order_bands": 3, "order_cuts_exact": exact}}).with_(forest_enabled=False)
    out = folder()
    r = run_pipeline(spark, shop(spark, lambda i: 500.0 if i == 60 else 100.0 + i % 7), out, cfg)
    cause = read_alerts(spark, r.alerts_path).where(F.col("ds") == d(60)).first()["root_cause_json"]
    assert '"dimension":"order_segment"' in cause and '"segment":"3 of 3"' in cause


def test_lookback_lays_a_row_per_flagged_day_and_segment(spark):
    """What is shuffled: segment-days, and flagged days times segments, not dates."""
    n_days, segments = 60, ["a", "b", "c", None]
    rows = [("all", d(i), "dim", s, 1.0 * i, i) for i in range(1, n_days + 1) for s in segments if s != "c" or i < 5]
    daily = spark.createDataFrame(rows, "series_id string, ds date, dimension string, segment string, revenue double, orders bigint")
    flagged = spark.createDataFrame([("all", d(40), "revenue"), ("all", d(41), "orders")], "series_id string, ds date, primary_kpi string")
    changes = segment_changes(flagged, daily, EngineConfig())
    got = {(r["anomaly_ds"], r["segment"], r["unknown_today"]): (r["today"], r["baseline"]) for r in changes.collect()}
    mean = sum(range(10, 40)) / 30
    assert got[d(40), "a", None] == (40.0, mean) and got[d(40), None, True] == (40.0, 0.0) and got[d(40), None, False] == (0.0, mean)
    assert not [k for k in got if k[1] == "c"] and len(got) == 8
    assert flagged_segments(flagged, daily).count() == 2 * len(segments)
    plan = changes._jdf.queryExecution().toString()
    assert "RangeFrame" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
