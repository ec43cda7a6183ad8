from __future__ import annotations

import hashlib

import numpy as np

from tidewarden.llm import covertree
from tidewarden.llm.covertree import CoverTree, product_codes

SCHEMA = "vec_id bigint, embedding array<bigint>, label int, code string, error string, part int, ids long"


def plain(rows: list[tuple], parts: int, entries: int, rounds: int) -> list[tuple]:
    rows = [r for r in rows if r[1] is not None and None not in r[1]]
    width = max(1, -(-max(len(r[1]) for r in rows) // parts)) * parts
    rows = sorted(([*v, *[0] * (width - len(v))], i, label) for i, v, label in (r[:3] for r in rows))
    rows.sort(key=lambda r: (r[1] is None, r[1] or 0))
    x = np.array([r[0] for r in rows], dtype=object).reshape(len(rows), parts, -1)
    books = x[:entries].copy()

    def nearest():
        apart = [[[int(((v - c) ** 2).sum()) for c in books[:, p]] for v in x[:, p]] for p in range(parts)]
        return [[(min(d), d.index(min(d))) for d in part] for part in apart]

    for _ in range(rounds):
        best = nearest()
        for p in range(parts):
            for e in range(len(books)):
                own = [v for v, b in zip(x[:, p], best[p]) if b[1] == e]
                if own:
                    books[e, p] = sum(own) // len(own)
    best = nearest()
    digest = hashlib.sha256(",".join(str(v) for p in range(parts) for e in range(len(books)) for v in books[e, p]).encode()).hexdigest()
    code = ["".join(f"{best[p][n][1]:02x}" for p in range(parts)) for n in range(len(rows))]
    error = [sum(best[p][n][0] for p in range(parts)) for n in range(len(rows))]
    by_label: dict = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted((str(r[1]), c, e, by_label[r[2]], digest) for r, c, e in zip(rows, code, error))


def got(df) -> list[tuple]:
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def table(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, None, "x", 1, 1) for r in rows], SCHEMA)


def test_equals_plain_rounds_with_ties_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-4, 5, 8).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    # A third of all rows are one vector, which the codebooks hold several times.
    rows = [(i, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    df = table(spark, rows).repartition(5, "vec_id")
    monkeypatch.setattr(covertree, "BLOCK", 64)
    found = product_codes(df, parts=4, entries=6, rounds=3)
    assert found.columns == "vec_id code error label_error codebooks_sha256".split()
    assert got(found) == plain(rows, 4, 6, 3)


def test_odd_rows_and_empty_input(spark):
    rows = [
        (5, [1, 2, 3], 1), (5, [1, 2, 3], 1), (5, [1, 2, 2], None), (None, [7, 7, 7, 7], None), (None, [-7], 2), (2, [], 2),
        (3, None, 1), (4, [1, None], 1), (9, [100, -100, 50, 3], 4),
    ]
    df = table(spark, rows)
    assert got(product_codes(df, parts=2, entries=3, rounds=2)) == plain(rows, 2, 3, 2)
    assert got(product_codes(df, parts=2, entries=64, rounds=2)) == plain(rows, 2, 64, 2)
    assert got(product_codes(df.limit(0))) == [] and got(product_codes(df.where("vec_id = 3"))) == []
    assert got(product_codes(df.where("vec_id = 2"), parts=2)) == plain([(2, [], 2)], 2, 64, 2)


def test_nodes_cover_their_points_and_children_lie_apart():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (3000, 4))
    tree = CoverTree(x)
    assert (tree.points[tree.point] == x).all()
    for n in range(len(tree.centre)):
        inside = tree.points[tree.start[n] : tree.stop[n]]
        assert np.sqrt(((inside - tree.centre[n]) ** 2).sum(axis=1)).max() <= tree.reach[n]
        below = range(tree.first[n], tree.last[n])
        if below:
            centres = tree.centre[tree.first[n] : tree.last[n]]
            assert (centres[0] == tree.centre[n]).all()
            assert sorted(i for b in below for i in range(tree.start[b], tree.stop[b])) == list(range(tree.start[n], tree.stop[n]))
            apart = np.sqrt(covertree.squared(centres, centres).astype(float))
            assert (apart[~np.eye(len(centres), dtype=bool)] > tree.reach[n] / 2 - 1e-9).all()


def test_whole_nodes_are_taken_where_clusters_are_plain(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.integers(-5000, 5000, (10, 4))
    x = np.repeat(centres, 400, axis=0) + rng.integers(-9, 10, (4000, 4))
    tree, seen = CoverTree(x), []
    plainly = covertree.squared
    monkeypatch.setattr(covertree, "squared", lambda a, b: seen.append(len(a)) or plainly(a, b))
    codes = np.zeros(len(tree.points), dtype=np.int64)
    count, total = tree.assign(centres, codes)
    assert list(count) == [400] * 10 and (total.sum(axis=0) == x.sum(axis=0)).all()
    assert (codes[tree.point] == np.repeat(np.arange(10), 400)).all() and sum(seen) < 400
