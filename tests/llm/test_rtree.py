from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewarden.llm.rtree import LEAF, Tree, box_bounds, hard_negatives
from tidewarden.llm.vectors import finite, floored

SCHEMA = "vec_id bigint, embedding array<bigint>, label int, q long, tile long, low long, u string"


def plain(rows: list[tuple], anchors: set[int], positives: int = 5, negatives: int = 5) -> list[tuple]:
    rows = [r for r in rows if None not in r[:3] and None not in r[1]]
    width = max((len(r[1]) for r in rows), default=0)
    rows = [(i, [*v, *[0] * (width - len(v))], label) for i, v, label in (r[:3] for r in rows)]
    out = []
    for a, v, label in {(i, tuple(v), label) for i, v, label in rows if i in anchors}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in rows)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            window = [(t, n) for t, n, other in scored if other != label and -80 * s <= -100 * t <= -100 * s]
            out += [(a, p, rank + 1, n, -s, -t) for rank, (t, n) in enumerate(window[:negatives])]
    return sorted(out)


def got(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def test_equals_all_pairs_with_ties_and_many_tiles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 6, 6).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    # A third of all rows are one vector.
    rows = [(i, rows[0][1] if i % 3 == 1 else v, label) for i, v, label in rows]
    df = spark.createDataFrame([(*r, 1, 1, 1, "x") for r in rows], SCHEMA)
    found = hard_negatives(df, F.col("vec_id") % 20 == 0, tile=32)
    assert found.columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert got(found) == plain(rows, {i for i in range(400) if i % 20 == 0})


def test_odd_rows_and_empty_input(spark):
    rows = [
        (0, [3, 4, 5], 1), (0, [3, 4, 5], 1), (0, [1, 2], 1), (1, [3, 4], 1), (1, [3, 4], 1), (2, [3, 4, 4], 2), (2, [3, 4, 4], 2),
        (3, None, 1), (4, [1, None], 1), (5, [1, 1, 1], None), (None, [9, 9, 9], 1), (6, [], 2), (7, [-3, -4, -5], 1),
        (8, [4, 3, 2], 2), (9, [0, 0, 0], 3),
    ]
    df = spark.createDataFrame([(*r, None, 0, 5, None) for r in rows], SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") < 1)) == plain(rows, {0})
    assert got(hard_negatives(df, F.lit(None).cast("boolean"))) == []
    assert got(hard_negatives(df.limit(0), F.col("vec_id") < 1)) == []
    only_empty = df.where("vec_id = 6")
    assert got(hard_negatives(only_empty, F.lit(True))) == []


def test_large_components_are_exact(spark):
    big = 1 << 29
    rows = [(0, [big, 1], 1), (1, [big, 2], 1), (2, [big, 1], 2), (3, [big, 0], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<bigint>, label int")
    assert got(hard_negatives(df, F.col("vec_id") == 0)) == plain(rows, {0})


def test_boxes_bound_every_product_and_the_queue_prunes(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(-500, 500, (40, 8))
    x = np.repeat(centres, 50, axis=0) + rng.integers(-5, 6, (2000, 8))
    tree = Tree(np.arange(2000), np.array(["a"] * 2000), x)
    assert sorted(tree.ids) == list(range(2000)) and (tree.last - tree.first).max() <= LEAF
    query = x[:1]
    least, most = box_bounds(tree.low, tree.high, query)
    scores = tree.x @ query[0]
    for leaf in range(-(-2000 // LEAF)):
        own = scores[tree.first[leaf] : tree.last[leaf]]
        assert least[0][leaf] <= own.min() and own.max() <= most[0][leaf]
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            seen.append(key.stop - key.start)
            return np.asarray(self)[key]

    bounds = least[0].tolist(), most[0].tolist()
    top = int(scores.max())
    windows = [(-(2**62), 2**62, -(2**62)), (0, top - 1, 0)]
    found = tree.best(tree.x.view(Counting), query[0], bounds, np.ones(2000, dtype=bool), windows, 5)
    plainly = x @ query[0]
    for (low, high, _), (ids, best) in zip(windows, found):
        fits = np.flatnonzero((plainly >= low) & (plainly <= high))
        order = fits[np.lexsort((fits, -plainly[fits]))[:5]]
        assert list(ids) == list(order) and list(best) == list(plainly[order])
    assert sum(seen) < 1000


def test_floors_and_sound_vectors(spark):
    rows = [(1, [0.999, -0.001]), (2, [float("nan")]), (3, [float("inf")]), (4, [None]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "id int, v array<float>").where(finite(F.col("v")))
    assert df.select("id", floored(F.col("v"))).collect() == [(1, [255, -1]), (6, [])]
