"""Alert filtering, cooldown, ranking and wording."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import alerts, d
from tidewarden.config import EngineConfig
from tidewarden.functions.columns import detector_count, detectors_from_text
from tidewarden.operators.alerts import (
    NOTIFICATION_COLUMNS,
    apply_cooldown,
    meaningful,
    normalise_alerts,
    notifications,
    prioritise,
)


def test_meaningful(spark):
    rows = [
        ({"risk_level": "LOW", "z_score": 2.49}, False),
        ({"risk_level": "low", "z_score": -2.5}, True),
        ({"risk_level": "medium", "z_score": None}, True),
        ({"risk_level": "HIGH", "validation_status": "fail"}, False),
        ({"risk_level": "NONE", "z_score": None}, False),
        ({"risk_level": None, "z_score": 3.0, "validation_status": None}, True),
    ]
    df = alerts(spark, [{**r, "kpi": str(i)} for i, (r, _) in enumerate(rows)])
    got = {r.kpi: r.m for r in df.select("kpi", meaningful().alias("m")).collect()}
    assert [got[str(i)] for i in range(len(rows))] == [e for _, e in rows]


def sent(spark, days, cooldown=3, **extra):
    df = alerts(spark, [{"ds": x, **extra} for x in days])
    return sorted((r.ds for r in apply_cooldown(df, cooldown).collect()), key=str)


def test_cooldown_counts_from_the_last_sent(spark):
    assert sent(spark, [d(i) for i in (1, 2, 3, 4, 6, 7, 9)]) == [d(1), d(4), d(7)]


def test_cooldown_of_undated_alerts(spark):
    assert sent(spark, [None, None]) == [None]
    assert sent(spark, [d(1), None]) == [d(1)]


def test_cooldown_of_repeated_days(spark):
    assert sent(spark, [d(1), d(1), d(2)], 1) == [d(1), d(2)]
    assert sent(spark, [d(1), d(1), d(2)], 0) == [d(1), d(1), d(2)]


def test_the_strongest_alert_of_a_day_is_sent(spark):
    df = alerts(spark, [{"risk_level": "LOW", "z_score": 9.0}, {"risk_level": "HIGH", "z_score": 1.0}])
    assert [r.risk_level for r in apply_cooldown(df).collect()] == ["HIGH"]


def test_cooldown_against_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(k, s, d(rng.randint(1, 400))) for k in ("revenue", "aov", None) for s in ("a", "b") for _ in range(150)]
    df = alerts(spark, [{"kpi": k, "series_id": s, "ds": x} for k, s, x in rows])
    want = set()
    last = {}
    for k, s, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if (k, s) not in last or (x - last[k, s]).days >= 5:
            last[k, s] = x
            want.add((k, s, x))
    got = [(r.kpi, r.series_id, r.ds) for r in apply_cooldown(df, 5).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("cooldown", [0, 1, 6])
def test_jumps_give_what_the_fold_gives(spark, cooldown):
    rng = random.Random(cooldown)
    rows = [{"kpi": rng.choice(["revenue", None]), "series_id": rng.choice(["a", None]), "ds": d(rng.randint(1, 300)), "value": float(i)} for i in range(500)]
    rows += [{"kpi": "aov", "ds": None}, {"kpi": "aov", "ds": None, "value": 2.0}, {"kpi": "orders", "ds": None}, {"kpi": "orders", "ds": d(5)}]
    for part in (rows, rows[-4:], []):
        df = alerts(spark, part)
        got, want = (sorted(map(str, apply_cooldown(df, cooldown, long).collect())) for long in (True, False))
        assert got == want and (got or not part)


def test_priority(spark):
    rows = [("HIGH", 1.0, d(2)), ("HIGH", None, d(1)), ("LOW", 9.0, d(1)), ("HIGH", -1.0, d(1)), ("HIGH", 1.0, None)]
    df = alerts(spark, [{"risk_level": r, "z_score": z, "ds": x} for r, z, x in rows])
    assert [(r.risk_level, r.z_score, r.ds) for r in prioritise(df).collect()] == [
        ("HIGH", -1.0, d(1)), ("HIGH", 1.0, d(2)), ("HIGH", 1.0, None), ("HIGH", None, d(1)), ("LOW", 9.0, d(1))
    ]


@pytest.mark.parametrize(
    "text, count",
    [
        ("{'rule': True, 'z': False, 'iqr': True, 'iforest': False}", 2),
        ("{'rule': True, 'z': None}", 1),
        ("garbage", 0),
        (None, 0),
        ("", 0),
    ],
)
def test_detectors_from_text(spark, text, count):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(detector_count(detectors_from_text(F.col("text"))).alias("n")).first().n == count


EVIDENCE = {
    "primary_kpi": "revenue",
    "evidence": [
        {"dimension": "customer_state", "top": [{"segment": "SP", "today": 1.0, "baseline": 9001.0, "delta": -9000.0, "pct_contrib": 0.4}]},
        {"dimension": "product_category_name", "top": [{"segment": "relogios_presentes", "today": 0.0, "baseline": 4000.0, "delta": -4000.0, "pct_contrib": 0.178}]},
        {"dimension": "payment_type", "top": [{"segment": "x", "today": 0.0, "baseline": 1.0, "delta": -1.0, "pct_contrib": 0.1}]},
    ],
}
GOLDEN = """🔴 *HIGH KPI Alert*
*Date:* 2018-07-07 00:00:00
*KPI:* Revenue
*Observed Value:* $11,023.00
*Baseline:* $33,631.00
*Z-Score:* -1.96
*Validation Status:* PASS
*Detectors Fired:* {'rule': True, 'z': False, 'iqr': True, 'iforest': False}
*Root Cause Summary:* Primary KPI: revenue. customer_state: top driver = SP (delta=-9,000.00, contribution=40.0%) | product_category_name: top driver = relogios_presentes (delta=-4,000.00, contribution=17.8%)"""


def message(spark, **changes):
    row = {
        "ds": d(188), "value": 11023.0, "baseline": 33631.0, "z_score": -1.96,
        "detectors": (True, False, True, False), "root_cause_json": json.dumps(EVIDENCE),
    } | changes
    return notifications(alerts(spark, [row]), EngineConfig()).first().message


def test_golden_message(spark):
    assert message(spark) == GOLDEN
    assert message(spark, injected_label="Outage") == GOLDEN + "\nSimulation Tag: Outage"
    assert message(spark, injected_label="  ") == GOLDEN


def test_message_of_unusual_values(spark):
    text = message(spark, value=-5.0, baseline=None, z_score=None)
    assert "*Observed Value:* $-5.00\n*Baseline:* N/A\n*Z-Score:* N/A\n" in text
    text = message(spark, kpi="payment_fail_rate", value=1234.5, baseline=0.125)
    assert "*KPI:* Payment Fail Rate\n*Observed Value:* 1,234.50\n*Baseline:* 0.12\n" in text


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, "No root cause evidence available."),
        ("", "No root cause evidence available."),
        ("{oops", "Root cause evidence present but could not be parsed."),
        ("{}", "Primary KPI: unknown. Root cause evidence present but not easily summarized."),
        (json.dumps({"primary_kpi": "aov", "evidence": [{"dimension": "x", "top": []}]}), "Primary KPI: aov. Root cause evidence present but not easily summarized."),
        (
            json.dumps({"primary_kpi": "aov", "evidence": [{"dimension": "x", "top": [{"segment": None, "delta": None, "pct_contrib": 0.5}]}]}),
            "Primary KPI: aov. x: top driver = None (delta=N/A, contribution=50.0%)",
        ),
    ],
)
def test_root_cause_summary(spark, text, expected):
    assert message(spark, root_cause_json=text).endswith(f"*Root Cause Summary:* {expected}")


def test_no_alerts_give_an_empty_table_with_all_columns(spark):
    out = notifications(alerts(spark, [{"risk_level": "NONE", "z_score": 0.0}]), EngineConfig())
    assert out.columns == list(NOTIFICATION_COLUMNS) and out.count() == 0


def test_alerts_read_as_text_are_coerced(spark):
    df = spark.createDataFrame(
        [("2018-01-01 00:00:00", "aov", "x", "2.5", "3", "HIGH", "{'rule': True, 'z': True}", "{}", "PASS")],
        "ds string, kpi string, value string, baseline string, z_score string, risk_level string, detectors string, root_cause_json string, validation_status string",
    )
    row = normalise_alerts(df).first()
    assert (row.series_id, row.ds, row.value, row.baseline, row.z_score, row.injected_label) == ("all", d(1), None, 2.5, 3.0, None)
    assert tuple(row.detectors) == (True, True, False, False)
