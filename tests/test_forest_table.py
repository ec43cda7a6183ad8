"""A forest fitted once, and new days scored by it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.helpers import d
from tidewarden import EngineConfig
from tidewarden.operators.iforest import fit_forest, forest_cutoffs, score_days, score_forest

CFG = EngineConfig(forest_trees=20, forest_blocks=3, forest_sample=32)
SCHEMA = "series_id string, ds date, revenue double, orders double, aov double, payment_fail_rate double"


def days(spark, first, last, series=("a", None, "gone")):
    rows = [
        (s, d(i), 100.0 + i % 7 + (900.0 if i in (50, 95) else 0.0), 10.0 + i % 3, None if s == "gone" else 5.0 + i % 2, 0.1)
        for s in series for i in range(first, last)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted((str(r["series_id"]), str(r["ds"]), r["iforest_score"], r["iforest_raw"]) for r in df.collect())


def test_fit_and_score_equal_both_at_once(spark):
    wide = days(spark, 1, 91)
    forest = fit_forest(wide, CFG)
    assert forest.columns == "series_id tree node feature cut size".split()
    roots = forest.where("node = 0").groupBy("series_id").agg(F.count("tree").alias("n"), F.max("size").alias("size")).collect()
    assert sorted((str(r["series_id"]), r["n"], r["size"]) for r in roots) == [("None", 20, 32), ("a", 20, 32)]
    assert got(score_days(forest, wide, CFG)) == got(score_forest(wide, CFG))


def test_new_days_are_scored_alone_by_the_stored_forest(spark):
    wide = days(spark, 1, 91)
    fitted = fit_forest(wide, CFG)
    forest = spark.createDataFrame(fitted.collect(), fitted.schema)
    cutoffs = forest_cutoffs(score_forest(wide, CFG), CFG)
    new = got(score_days(forest, days(spark, 91, 99, ("a", None, "b")), CFG, cutoffs))
    flagged = {(s, day) for s, day, _, raw in new if raw}
    assert {("a", str(d(95))), ("None", str(d(95)))} <= flagged
    assert all(score is None and raw is None for s, _, score, raw in new if s == "b") and len(new) == 24
    # Each day's score is its own: scored with others or alone, it is the same.
    alone = got(score_days(forest, days(spark, 95, 96, ("a",)), CFG, cutoffs))
    assert alone == [r for r in new if r[:2] == ("a", str(d(95)))]
    assert got(score_days(forest, days(spark, 1, 1), CFG, cutoffs)) == []
