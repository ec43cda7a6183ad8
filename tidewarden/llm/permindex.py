"""Nearest neighbours by a permutation index.

Pivots are drawn from a bounded sample. A vector is represented by the pivots in order
of nearness, and posted in the inverted files of its nearest ``posts`` pivots. A query
reads the files of its nearest pivots, ranks what it finds by the footrule distance (the
summed difference of each pivot's place in the two orders), and compares the best share
of each file by the exact measure. Files are cut into blocks, and so are the queries
that read one, so a task holds two blocks whatever a pivot attracts; a query's best of
all blocks meet in a window.

Every vector is indexed. Raising ``probe_share`` and ``rerank_share`` to 1 makes the
search exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from .columns import hash_share

PIVOTS = 128
SAMPLE = 4096
"""Vectors, about, that pivots are drawn from: those whose id's hash falls into a share
of all hashes that is made for so many."""
POSTS = 2
PROBE_SHARE = 0.5
RERANK_SHARE = 0.15
RERANK_LEAST = 64
"""Candidates of a block that are compared exactly at least."""
BLOCK = 1024
"""Vectors, or queries, of a block."""
K = 20


def usable(embedding: Column) -> Column:
    """Not null or empty, without null or non-finite components, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        embedding.isNotNull()
        & F.coalesce(F.forall(embedding, finite), F.lit(False))
        & F.coalesce(F.exists(embedding, lambda x: x != 0), F.lit(False))
    )


def draw_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Up to ``pivots`` different vectors of the sample's commonest length, each far from
    those before it: the next pivot is the sampled vector least near to any so far."""
    hashed = vectors.withColumn("hash", F.xxhash64("id"))
    rows = hash_share(hashed, "hash", sample).groupBy("hash").agg(F.min("vector").alias("vector")).collect()
    rows.sort(key=lambda r: r["hash"])
    lengths = [len(r["vector"]) for r in rows]
    if not rows:
        return np.zeros((0, 0))
    width = max(set(lengths), key=lambda n: (lengths.count(n), n))
    some = np.unique(np.array([r["vector"] for r in rows if len(r["vector"]) == width], dtype=np.float64), axis=0)
    unit = some / np.linalg.norm(some, axis=1, keepdims=True)
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(pivots, len(unit)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def _places(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each pivot's place in each vector's order of nearness."""
    order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")
    places = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(places, order, np.arange(len(pivots), dtype=np.int16)[None, :], axis=1)
    return places


def _poster(pivots: np.ndarray, files: int):
    """Rows ``(id, vector, pivot)`` for the nearest ``files`` pivots of each vector."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
            order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :files]
            at = np.repeat(np.arange(len(pdf)), order.shape[1])
            out = pdf.iloc[at].reset_index(drop=True)
            yield out.assign(pivot=order.ravel().astype(np.int32))

    return post


def _searcher(pivots: np.ndarray, k: int, rerank_share: float):
    def search(file: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(file) or not len(asked):
            return empty
        file = file.sort_values("id", kind="stable")
        ids = file["id"].to_numpy()
        x = np.stack(file["vector"].to_numpy()).astype(np.float64)
        places = _places(x, pivots)
        q_ids = asked["id"].to_numpy()
        q = np.stack(asked["vector"].to_numpy()).astype(np.float64)
        q_places = _places(q, pivots)
        # One more than asked, as the query itself may be among them.
        keep = min(len(ids), max(RERANK_LEAST, k + 1, math.ceil(rerank_share * len(ids))))
        found = []
        for i in range(len(q)):
            if keep < len(ids):
                footrule = np.abs(places - q_places[i]).sum(axis=1, dtype=np.int64)
                # Ties to the smaller id: its place in the file breaks them.
                order = footrule * len(ids) + np.arange(len(ids))
                best = np.sort(np.argpartition(order, keep - 1)[:keep])
            else:
                best = np.arange(len(ids))
            score = np.einsum("ij,j->i", x[best], q[i])
            other = ids[best] != q_ids[i]
            best, score = best[other], score[other]
            top = np.lexsort((ids[best], -score))[:k]
            found.append((np.full(len(top), q_ids[i]), ids[best[top]], score[top]))
        return pd.DataFrame({n: np.concatenate([f[j] for f in found]) for j, n in enumerate(("query_id", "id", "score"))})

    return search


def _blocks(df: DataFrame) -> dict[int, int]:
    """Blocks by pivot; one row per pivot comes to the driver."""
    return {r["pivot"]: max(1, math.ceil(r["count"] / BLOCK)) for r in df.groupBy("pivot").count().collect()}


def _count(sizes: dict[int, int]) -> Column:
    if not sizes:
        return F.lit(1)
    lookup = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, F.col("pivot")), F.lit(1))


def _own(sizes: dict[int, int]) -> Column:
    return F.pmod(F.xxhash64("id"), _count(sizes)).cast("int")


def _every(sizes: dict[int, int]) -> Column:
    return F.explode(F.sequence(F.lit(0), _count(sizes) - 1))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    pivots: int = PIVOTS,
    sample: int = SAMPLE,
    posts: int = POSTS,
    probe_share: float = PROBE_SHARE,
    rerank_share: float = RERANK_SHARE,
) -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` of ``vectors`` found nearest to each
    row of ``queries`` by inner product, best first, ties to the smaller id. A query for
    which its files hold fewer than ``k`` is compared with all vectors, so that only a
    query with fewer candidates has fewer rows.

    A row of the query's own id is no candidate. Vectors that are null, zero, hold null
    or non-finite components, have another length than the pivots or a null id take no
    part on either side. Rows that share an id are one candidate, at their best score,
    and one query. Other columns are not read; an empty input gives an empty table.
    """
    spark = vectors.sparkSession
    step = new_steps(spark, "permindex")
    read = lambda df: df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    base, asked = read(vectors), read(queries)
    at = draw_pivots(base, pivots, sample)
    n, width = at.shape
    base, asked = (df.where(F.size("vector") == width) for df in (base, asked))
    if not n:
        return spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score double")
    schema = "id bigint, vector array<double>, pivot int"
    posted = base.mapInPandas(_poster(at, min(posts, n)), schema)
    files = _blocks(posted)

    def search(some: DataFrame, probes: int, share: float) -> DataFrame:
        probing = some.mapInPandas(_poster(at, probes), schema)
        chunks = _blocks(probing)
        left = posted.withColumn("file", _own(files)).withColumn("chunk", _every(chunks))
        right = probing.withColumn("chunk", _own(chunks)).withColumn("file", _every(files))
        key = ["pivot", "file", "chunk"]
        found = (
            left.groupBy(*key)
            .cogroup(right.groupBy(*key))
            .applyInPandas(_searcher(at, k, share), "query_id bigint, id bigint, score double")
        )
        once = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    ranked = step(search(asked, max(1, math.ceil(probe_share * n)), rerank_share), "ranked")
    enough = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = step(asked.join(enough, "id", "left_anti"), "short")
    if not short.isEmpty():
        rest = ranked.join(enough.withColumnRenamed("id", "query_id"), "query_id", "left_semi")
        ranked = rest.unionByName(search(short, n, 1.0))
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
