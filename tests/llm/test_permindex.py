from __future__ import annotations

import numpy as np

from tidewarden.llm.permindex import nearest


def brute_force(rows, k=20):
    x = {i: np.array(v, dtype=float) for i, v in rows}
    ids = np.array(sorted(x))
    table = np.stack([x[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        score = np.einsum("ij,j->i", table, x[q])
        order = [n for n in np.lexsort((ids, -score)) if ids[n] != q][:k]
        out[int(q)] = [(int(ids[n]), float(score[n])) for n in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        rows = out.setdefault(r["query_id"], [])
        rows.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(rows)
    return out


def test_recall_and_exact_scores(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = found(nearest(v, v.where("vec_id % 20 = 0")))
    want = brute_force([(r["vec_id"], r["embedding"]) for r in v.collect()])
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    scores = {(q, i): s for q, rows in want.items() for i, s in rows}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, rows in got.items() for i, s in rows if (q, i) in scores)


def test_exact_when_all_files_are_read(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = found(nearest(v, v.where("vec_id % 20 = 0"), pivots=16, probe_share=1.0, rerank_share=1.0))
    want = brute_force([(r["vec_id"], r["embedding"]) for r in v.collect()])
    assert {q: [i for i, _ in rows] for q, rows in got.items()} == {q: [i for i, _ in rows] for q, rows in want.items()}


def test_one_vector_over_and_over(spark):
    """A third of all vectors alike: ties go to the smaller id, and none is lost."""
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(3000)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = found(nearest(v, v.where("vec_id % 300 = 0")))
    want = brute_force(rows)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in got]
    assert len(got) == 10 and np.mean(hits) >= 0.9
    alike = [q for q in got if got[q] == want[q]]
    assert len(alike) >= 8


def test_odd_vectors_and_empty_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [nan, 1.0]), (60, None), (80, [None, 1.0]), (None, [1.0, 1.0]),
        (1, [2.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [inf, 0.0]), (4, []), (5, [1.0, 2.0, 3.0]), (100, [-1.0, 0.0]),
    ]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS pivot", "2 AS id", "3 AS vector")
    got = found(nearest(v, v.where("vec_id % 20 = 0")))
    assert got == {0: [(1, 2.0), (2, 0.0), (100, -1.0)], 100: [(2, 0.0), (0, -1.0), (1, -2.0)]}
    none = v.limit(0)
    assert nearest(none, none).count() == 0
    assert nearest(v, none).count() == 0
