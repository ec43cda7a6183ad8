"""Root cause on small inputs, and against a brute-force reading of its rules."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import d
from tidewarden.config import EngineConfig
from tidewarden.operators.feeds import root_cause_signals
from tidewarden.operators.rootcause import attach_root_cause, contributions, evidence, primary_kpi

CFG = EngineConfig()


def days(spark, *rows):
    return spark.createDataFrame([("all", *r) for r in rows], "series_id string, ds date, primary_kpi string")


def segments(spark, rows):
    return spark.createDataFrame(
        [("all", *r) for r in rows],
        "series_id string, ds date, dimension string, segment string, revenue double, orders bigint",
    )


def listed(df):
    return [(r.segment, r.today, r.baseline, r.delta, round(r.pct_contrib, 4)) for r in df.orderBy("rank").collect()]


def test_unknown_segments_of_both_sides_do_not_match(spark):
    rows = [(d(40), None, 10.0), (d(40), "x", 5.0), (d(39), None, 4.0), (d(39), "y", 8.0)]
    seg = segments(spark, [(ds, "customer_state", s, v, 1) for ds, s, v in rows])
    assert listed(contributions(days(spark, (d(40), "revenue")), seg, CFG)) == [
        (None, 10.0, 0.0, 10.0, 3.3333),
        ("y", 0.0, 8.0, -8.0, -2.6667),
        ("x", 5.0, 0.0, 5.0, 1.6667),
        (None, 0.0, 4.0, -4.0, -1.3333),
    ]


def test_zero_total(spark):
    seg = segments(spark, [(d(40), "payment_type", "a", 5.0, 1), (d(39), "payment_type", "b", 5.0, 1)])
    assert [r[4] for r in listed(contributions(days(spark, (d(40), "revenue")), seg, CFG))] == [5e9, -5e9]


def test_baseline_is_over_the_days_a_segment_appears_on(spark):
    seg = segments(
        spark,
        [(d(40), "payment_type", "a", 1.0, 1), (d(39), "payment_type", "a", 10.0, 2), (d(10), "payment_type", "a", 20.0, 6), (d(9), "payment_type", "a", 999.0, 9)],
    )
    assert listed(contributions(days(spark, (d(40), "revenue")), seg, CFG))[0][:3] == ("a", 1.0, 15.0)
    assert listed(contributions(days(spark, (d(40), "aov")), seg, CFG))[0][:3] == ("a", 1.0, 4.0)


def test_every_dimension_is_in_the_evidence(spark):
    row = evidence(days(spark, (d(40), "orders")), contributions(days(spark, (d(40), "orders")), segments(spark, []), CFG), CFG).first()
    assert [(b.dimension, b.top) for b in row.evidence.evidence] == [(x, []) for x in CFG.dimensions]


def flags(spark, rows):
    schema = "series_id string, ds date, kpi string, risk_level string, z double, anomaly_flag boolean"
    return spark.createDataFrame([("all", d(40), *r) for r in rows], schema)


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("NONE", 1.0), ("NONE", -3.0), ("NONE", 3.0), ("NONE", None)], "orders"),
        ([("LOW", 1.0), ("NONE", 3.0), ("HIGH", None), ("HIGH", 0.1)], "payment_fail_rate"),
        ([("NONE", None)] * 4, "revenue"),
    ],
)
def test_primary_kpi(spark, rows, expected):
    df = flags(spark, [(k, *r, k == "aov") for k, r in zip(CFG.kpis, rows)])
    assert primary_kpi(df, CFG).first().primary_kpi == expected
    assert primary_kpi(df.withColumn("anomaly_flag", F.lit(False)), CFG).count() == 0


def test_json_keeps_unknown_segments(spark):
    df = flags(spark, [("revenue", "HIGH", 3.0, True)])
    seg = segments(spark, [(d(40), "customer_state", None, 2.0, 1)])
    text = attach_root_cause(df, seg, CFG).first().root_cause_json
    document = json.loads(text)
    assert document["primary_kpi"] == "revenue"
    assert [b["dimension"] for b in document["evidence"]] == list(CFG.dimensions)
    assert document["evidence"][0]["top"] == [{"segment": None, "today": 2.0, "baseline": 0.0, "delta": 2.0, "pct_contrib": 1.0}]


def brute(day, kpi, dimension, rows, cfg):
    """The rules, segment by segment."""
    value = {"revenue": 3}.get(kpi, 4)
    today, before = {}, {}
    for r in rows:
        if r[1] != dimension:
            continue
        age = (day - r[0]).days
        if age == 0:
            today[r[2]] = float(r[value])
        elif 0 < age <= cfg.lookback_days:
            before.setdefault(r[2], []).append(r[value])
    out = []
    for s in set(today) | set(before):
        base = sum(before[s]) / len(before[s]) if s in before else 0.0
        if s is None:
            out += [(s, today[s], 0.0)] if s in today else []
            out += [(s, 0.0, base)] if s in before else []
        else:
            out.append((s, today.get(s, 0.0), base))
    out = sorted(out, key=lambda r: (-abs(r[1] - r[2]), r[0] is None, str(r[0])))[:50]
    total = sum(r[1] - r[2] for r in out) or 1e-9
    return [(*r, r[1] - r[2], (r[1] - r[2]) / total) for r in out][: min(5, cfg.top_n)]


@pytest.mark.parametrize("top_n", [3, 9])
def test_against_brute_force(spark, top_n):
    rng = random.Random(5)
    cfg = EngineConfig(top_n=top_n)
    names = [None, *[f"s{i:02d}" for i in range(80)]]
    rows = [
        (d(i), dim, s, round(rng.uniform(1, 999), 2), rng.randint(1, 9))
        for i in range(1, 80)
        for dim in cfg.dimensions
        for s in rng.sample(names, 60)
    ]
    chosen = [(d(i), rng.choice(cfg.kpis)) for i in (3, 40, 41, 60, 79, 85)]
    found = evidence(days(spark, *chosen), contributions(days(spark, *chosen), segments(spark, rows), cfg), cfg)
    got = {}
    for r in root_cause_signals(found).orderBy("rank").collect():
        got.setdefault((r.ds, r.dimension), []).append((r.segment, r.today, r.baseline, r.delta, r.pct_contrib))
    for day, kpi in chosen:
        for dim in cfg.dimensions:
            want = brute(day, kpi, dim, rows, cfg)
            have = got.get((day, dim), [])
            assert [pytest.approx(w[3:], rel=1e-6) for w in want] == [h[3:] for h in have]
            distinct = [w for w in want if sum(abs(abs(w[3]) - abs(x[3])) < 1e-9 for x in want) == 1]
            assert {w[0] for w in distinct[:-1]} <= {h[0] for h in have}
