"""Rolling statistics, detectors, risk and the forest on small inputs."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import d, long, wide
from tidewarden.config import EngineConfig
from tidewarden.operators.baseline import add_rolling_stats, fill_gaps
from tidewarden.operators.detect import detect_anomalies
from tidewarden.operators.iforest import mean_path, path_lengths, score_forest
from tidewarden.operators.kpis import to_long
from tidewarden.operators.risk import classify_risk
from tidewarden.plans.pipeline import features, wide_features

CFG = EngineConfig(forest_enabled=False)
NAN = float("nan")


def rolled(spark, values, cfg=CFG):
    return add_rolling_stats(long(spark, values), cfg).orderBy("ds").collect()


def test_rolling_mean_std_and_z(spark):
    rows = rolled(spark, range(1, 8))
    last = rows[-1]
    assert (last.rolling_mean, last.rolling_std, last.z, last.row_pos) == (4.0, 2.0, 1.5, 6)
    assert all(r.rolling_mean is None and r.rolling_std is None and r.z is None for r in rows[:6])


def test_constant_series_has_no_z_and_no_flag(spark):
    out = detect_anomalies(add_rolling_stats(long(spark, [5] * 40), CFG), CFG).collect()
    assert all(r.z is None and not r.anomaly_z and not r.anomaly_flag for r in out)
    assert out[-1].rolling_std == 0


def test_z_cannot_exceed_its_bound(spark):
    assert rolled(spark, [0] * 6 + [1])[-1].z == pytest.approx(math.sqrt(6))
    rng = np.random.default_rng(1)
    assert max(abs(r.z) for r in rolled(spark, rng.lognormal(0, 3, 200).tolist()) if r.z) <= math.sqrt(6) + 1e-9


def test_quartile_fences(spark):
    last = rolled(spark, range(1, 31))[-1]
    assert (last.iqr_lo, last.iqr_hi, last.baseline) == (-13.5, 44.5, 15.5)


def test_a_null_makes_every_frame_with_it_null(spark):
    values = list(range(1, 61))
    values[19] = None
    rows = rolled(spark, values)
    assert [r.rolling_mean is None for r in rows] == [i < 6 or 19 <= i <= 25 for i in range(60)]
    assert [r.baseline is None for r in rows] == [i < 29 or 19 <= i <= 48 for i in range(60)]
    nan_rows = add_rolling_stats(to_long(wide(spark, [(d(i), NAN if i == 5 else 1.0, 1.0, 1.0, 1.0) for i in range(1, 9)])), CFG)
    assert nan_rows.where((F.col("kpi") == "revenue") & F.col("rolling_mean").isNotNull()).count() == 0


def test_frames_count_rows_not_days(spark):
    df = long(spark, range(1, 9)).where(F.col("value") != 4)
    assert add_rolling_stats(df, CFG).orderBy("ds").collect()[-1].rolling_mean == pytest.approx((1 + 2 + 3 + 5 + 6 + 7 + 8) / 7)


def test_fill_gaps(spark):
    rows = [(d(1), None, None, 1.0, 1.0), (d(2), 3.0, None, None, 2.0), (d(3), None, None, None, 3.0)]
    out = fill_gaps(wide(spark, rows), ["revenue", "orders", "aov", "payment_fail_rate"]).orderBy("ds").collect()
    assert [r.revenue for r in out] == [3.0, 3.0, 3.0]
    assert [r.orders for r in out] == [None] * 3
    assert [r.aov for r in out] == [1.0] * 3


def ready(spark, rows, schema_extra=""):
    """Rows that already have statistics."""
    schema = (
        "series_id string, ds date, kpi string, value double, row_pos int, baseline double, z double, "
        "iqr_lo double, iqr_hi double, iforest_raw boolean"
    )
    return spark.createDataFrame([("all", d(i + 1), *r) for i, r in enumerate(rows)], schema)


def test_cold_start_is_by_position(spark):
    cfg = EngineConfig()
    rows = [("aov", 200.0, pos, 100.0, 0.0, 0.0, 150.0, True) for pos in (34, 35)]
    out = detect_anomalies(ready(spark, rows), cfg).orderBy("row_pos").collect()
    assert [(r.anomaly_rule, r.anomaly_iqr, r.anomaly_iforest, r.anomaly_flag) for r in out] == [
        (True, True, False, False),
        (True, True, True, True),
    ]


def test_limits_are_strict_and_unknown_is_false(spark):
    rows = [
        ("aov", 120.0, 99, 100.0, 2.5, 0.0, 120.0, None),
        ("aov", 80.0, 99, 100.0, -2.5, 80.0, 120.0, False),
        ("aov", None, 99, 100.0, None, None, None, None),
        ("aov", 5.0, 99, 0.0, None, 1.0, 9.0, True),
    ]
    out = detect_anomalies(ready(spark, rows), EngineConfig()).orderBy("ds").collect()
    assert [(r.anomaly_rule, r.anomaly_z, r.anomaly_iqr, r.anomaly_flag) for r in out] == [(False,) * 4] * 4


@pytest.mark.parametrize(
    "kpi, value, baseline, z, flag, expected",
    [
        ("aov", 1.0, 1.0, 1.9, True, "NONE"),
        ("aov", 1.0, 1.0, -2.0, True, "LOW"),
        ("aov", 1.0, 1.0, 2.5, True, "MEDIUM"),
        ("aov", 1.0, 1.0, -3.5, True, "HIGH"),
        ("aov", 1.0, 1.0, 3.5, False, "NONE"),
        ("aov", 60.0, 100.0, 0.0, True, "NONE"),
        ("revenue", 70.0, 100.0, 0.0, True, "HIGH"),
        ("revenue", 70.0, 100.0, 0.0, False, "NONE"),
        ("revenue", 71.0, 100.0, None, True, "NONE"),
        ("revenue", 11023.0, 33631.0, -1.96, True, "HIGH"),
    ],
)
def test_risk_levels(spark, kpi, value, baseline, z, flag, expected):
    df = spark.createDataFrame(
        [(kpi, value, baseline, z, flag)], "kpi string, value double, baseline double, z double, anomaly_flag boolean"
    )
    assert classify_risk(df, CFG).first().risk_level == expected


def test_mean_path():
    assert mean_path(np.array([0, 1, 2])).tolist() == [0, 0, 1]
    assert mean_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-4)


def test_path_lengths_isolate_outliers():
    x = np.random.default_rng(0).normal(size=(500, 3))
    x[17] = 9.0
    keys, days = [f"1|{t}" for t in range(50)], [str(d(i)) for i in range(500)]
    total = path_lengths(x, keys, days)
    assert total.argmin() == 17
    parts = sum(path_lengths(x, keys[i::4], days) for i in range(4))
    assert (parts == total).all()


def one_tree(x, key, days):
    """Path lengths over one tree, node by node, from the same draws."""
    size = min(256, len(x))
    height = max(1, math.ceil(math.log2(max(size, 2))))
    hashes = [md5(f"{key}|{day}".encode()).hexdigest() for day in days]
    sample = x[sorted(range(len(x)), key=hashes.__getitem__)[:size]]
    draws = np.array(
        [
            [int(h[:8], 16) / 2**32, int(h[8:16], 16) / 2**32]
            for h in (md5(f"{key}|n{n}".encode()).hexdigest() for n in range((1 << (height + 1)) - 1))
        ]
    )

    def walk(rows, points, node, depth, out, index):
        varying = [f for f in range(x.shape[1]) if rows[:, f].max() > rows[:, f].min()]
        if depth == height or len(rows) < 2 or not varying:
            out[index] = depth + float(mean_path(np.array([len(rows)]))[0])
            return
        f = varying[int(draws[node, 0] * len(varying))]
        lo, hi = rows[:, f].min(), rows[:, f].max()
        cut = lo + draws[node, 1] * (hi - lo)
        cut = lo if cut >= hi else cut
        left, here = rows[:, f] <= cut, points[:, f] <= cut
        walk(rows[left], points[here], 2 * node + 1, depth + 1, out, index[here])
        walk(rows[~left], points[~here], 2 * node + 2, depth + 1, out, index[~here])

    out = np.zeros(len(x))
    walk(sample, x, 0, 0, out, np.arange(len(x)))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 40, 256, 700])
def test_path_lengths_against_single_trees(n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 2] = 1.0
    keys, days = [f"4|2|{t}" for t in range(12)], [str(d(i)) for i in range(n)]
    want = sum(one_tree(x, k, days) for k in keys)
    assert path_lengths(x, keys, days) / (1 << 20) == pytest.approx(want, abs=1e-4)


def forest_input(spark, n=400):
    rng = np.random.default_rng(3)
    v = rng.normal(100, 5, (n, 4))
    v[min(123, n - 1)] = 500
    return wide(spark, [(d(i + 1), *map(float, v[i])) for i in range(n)])


def test_forest_flags_the_contaminated_share_whatever_the_partitioning(spark):
    cfg = EngineConfig()
    df = forest_input(spark)
    a = score_forest(df, cfg).orderBy("ds").collect()
    b = score_forest(df.repartition(7), cfg.with_(forest_blocks=3)).orderBy("ds").collect()
    assert a == b
    assert sum(r.iforest_raw for r in a) == 12
    assert max(a, key=lambda r: r.iforest_score).ds == d(124)
    assert all(0 < r.iforest_score < 1 for r in a)
    c = score_forest(df, cfg.with_(forest_seed=1)).orderBy("ds").collect()
    assert [r.iforest_score for r in c] != [r.iforest_score for r in a]


def test_series_have_their_own_forests(spark):
    df = forest_input(spark, 60)
    both = df.union(df.withColumn("series_id", F.lit("other")).withColumn("revenue", F.lit(None).cast("double")))
    out = score_forest(both, EngineConfig(forest_trees=20))
    scores = [(r.series_id, r.iforest_score is None, bool(r.iforest_raw)) for r in out.collect()]
    assert len(scores) == 120
    assert {s[:2] for s in scores} == {("all", False), ("other", True)} and ("other", True, True) not in scores
    assert features(both, EngineConfig(forest_trees=20)).where("series_id = 'other' AND anomaly_iforest").count() == 0


def test_wide_features_have_the_expected_columns(spark):
    out = wide_features(features(forest_input(spark, 40), EngineConfig(forest_trees=10)), EngineConfig())
    suffixes = "rm7 rs7 base30 z iqr_lo iqr_hi anomaly_rule anomaly_z anomaly_iqr anomaly_iforest anomaly_flag risk_level"
    assert {f"aov_{s}" for s in suffixes.split()} | {"aov", "revenue", "ds"} <= set(out.columns)
    assert out.count() == 40
