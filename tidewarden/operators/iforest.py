"""Isolation forest over the daily metrics of a series (Liu, Ting and Zhou, 2008).

The trees of a series are independent, so they are split over tasks: each task grows
its share of trees from samples of the series, sends all days of the series down them,
and returns the summed path length of each day. Spark adds these up. No forest is ever
stored, sent to the driver or broadcast. A task holds the days of one series, which the
calendar bounds, and works on all its trees at once with array operations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import join_same, number
from .baseline import fill_gaps

BATCH = 1_000_000
"""Days times trees that a task has in memory at once."""
UNIT = 1 << 20
"""Path lengths are summed in whole units of 1/UNIT, so that sums do not depend on
the order of addition."""


def mean_path(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    out = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, out))


def sampled(key: str, days: Sequence[str], size: int) -> np.ndarray:
    """The rows a tree is grown from: those of the smallest hashes of tree and day."""
    if size >= len(days):
        return np.arange(len(days))
    first = b"".join([md5(f"{key}|{d}".encode()).digest()[:8] for d in days])
    return np.argsort(np.frombuffer(first, dtype=">u8"), kind="stable")[:size]


def node_draws(key: str, nodes: int) -> np.ndarray:
    """Two numbers in [0, 1) for each node of a tree, from the hash of tree and node."""
    first = b"".join([md5(f"{key}|n{n}".encode()).digest()[:8] for n in range(nodes)])
    return np.frombuffer(first, dtype=">u4").reshape(nodes, 2) / 2.0**32


def height_of(size: int) -> int:
    """Levels below the root of a tree grown from so many rows."""
    return max(1, math.ceil(math.log2(max(size, 2))))


def grow(x: np.ndarray, keys: Sequence[str], days: Sequence[str], sample_size: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1 in a leaf), cut and number of sampled rows of each node of one tree per
    key, grown from the rows of ``x`` (of ``days``).

    Node ``i`` of a tree has children ``2i + 1`` and ``2i + 2``. Trees grow a level at
    a time: ``lo``/``hi`` are the ranges of the sampled rows in each node.
    """
    size = min(sample_size, len(x))
    height = height_of(size)
    nodes = (1 << (height + 1)) - 1
    sample = x[np.stack([sampled(k, days, size) for k in keys])]
    draws = np.stack([node_draws(k, nodes) for k in keys])

    trees = np.arange(len(keys))[:, None]
    at = np.zeros((len(keys), size), dtype=np.int64)
    feature = np.full((len(keys), nodes), -1, dtype=np.int64)
    cut = np.zeros((len(keys), nodes))
    count = np.zeros((len(keys), nodes), dtype=np.int64)
    for level in range(height + 1):
        here = (at >= (1 << level) - 1) & (at < (2 << level) - 1)
        flat = (trees * nodes + at)[here]
        if not len(flat):
            break
        order = np.argsort(flat, kind="stable")
        ids, starts, sizes = np.unique(flat[order], return_index=True, return_counts=True)
        count.flat[ids] = sizes
        if level == height:
            break
        rows = sample[here][order]
        lo = np.minimum.reduceat(rows, starts, axis=0)
        hi = np.maximum.reduceat(rows, starts, axis=0)
        varies = hi > lo
        splits = varies.any(axis=1)
        u = draws.reshape(-1, 2)[ids]
        pick = (u[:, 0] * varies.sum(axis=1)).astype(np.int64)
        chosen = np.argmax(np.cumsum(varies, axis=1) > pick[:, None], axis=1)
        each = np.arange(len(ids))
        low, high = lo[each, chosen], hi[each, chosen]
        value = low + u[:, 1] * (high - low)
        value = np.where(value >= high, low, value)
        feature.flat[ids[splits]] = chosen[splits]
        cut.flat[ids[splits]] = value[splits]
        at = _descend(sample, at, feature, cut, trees)

    return feature, cut, count


def walk(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Summed path length of each row of ``x`` over the trees."""
    k, nodes = feature.shape
    trees = np.arange(k)[:, None]
    spot = np.zeros((k, len(x)), dtype=np.int64)
    everyone = np.broadcast_to(x, (k, *x.shape))
    depth = np.floor(np.log2(np.arange(nodes) + 1.0))
    for _ in range(int(depth[-1])):
        spot = _descend(everyone, spot, feature, cut, trees)
    length = depth[spot] + mean_path(count[trees, spot])
    return np.rint(length * UNIT).astype(np.int64).sum(axis=0)


def path_lengths(x: np.ndarray, keys: Sequence[str], days: Sequence[str], sample_size: int = 256) -> np.ndarray:
    """Summed path length of each row of ``x`` (of ``days``) over one tree per key."""
    return walk(x, *grow(x, keys, days, sample_size))


def _descend(
    rows: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, trees: np.ndarray
) -> np.ndarray:
    """Move every row one level down its tree; rows in a leaf stay."""
    f = feature[trees, at]
    v = np.take_along_axis(rows, np.maximum(f, 0)[:, :, None], axis=2)[:, :, 0]
    return np.where(f < 0, at, 2 * at + 1 + (v > cut[trees, at]))


def _block_scorer(kpis: Sequence[str], cfg: EngineConfig) -> Callable[[pd.DataFrame], pd.DataFrame]:
    trees, blocks, seed = cfg.forest_trees, max(1, cfg.forest_blocks), cfg.forest_seed

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", kind="stable")
        x = pdf[list(kpis)].to_numpy(dtype=float)
        series, block = pdf["series_id"].iloc[0], int(pdf["block"].iloc[0])
        days = [str(ds) for ds in pdf["ds"]]
        mine = [f"{seed}|{series}|{t}" for t in range(block, trees, blocks)]
        out = pdf[["series_id", "ds"]].assign(path=pd.array([0] * len(pdf), dtype="Int64"), rows=len(pdf))
        if np.isnan(x).any():
            return out.assign(path=pd.array([None] * len(pdf), dtype="Int64"))
        if not mine:
            return out
        some = max(1, BATCH // len(x))
        parts = (path_lengths(x, mine[i : i + some], days, cfg.forest_sample) for i in range(0, len(mine), some))
        return out.assign(path=sum(parts))

    return score


def score_forest(wide: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Score and flag of each day, as ``(series_id, ds, iforest_score, iforest_raw)``.

    Flagged are the days whose score is beyond the quantile that the contamination
    leaves above it. A series with a metric that is missing on every day has its days with
    a NULL score, and no flag; the quality report names the metric.
    """
    kpis = list(cfg.kpis)
    paths = (
        _dealt(wide, cfg)
        .applyInPandas(
            _block_scorer(kpis, cfg), "series_id string, ds date, path bigint, rows bigint"
        )
        .groupBy("series_id", "ds")
        .agg(F.sum("path").alias("path"), F.max("rows").alias("rows"))
    )
    return _flagged(_scores(paths.withColumn("size", F.least(F.col("rows"), F.lit(cfg.forest_sample))), cfg), cfg)


def _scores(paths: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Scores of summed path lengths over trees grown from ``size`` rows."""
    size = F.col("size").cast("double")
    norm = (
        F.when(size > 2, 2.0 * (F.log(size - 1.0) + float(np.euler_gamma)) - 2.0 * (size - 1.0) / size)
        .when(size == 2, 1.0)
    )
    mean = F.col("path") / F.lit(float(UNIT)) / F.lit(float(cfg.forest_trees))
    return paths.select("series_id", "ds", F.pow(F.lit(2.0), -mean / norm).alias("iforest_score"))


def _flagged(scores: DataFrame, cfg: EngineConfig) -> DataFrame:
    whole = Window.partitionBy("series_id")
    cutoff = F.percentile("iforest_score", F.lit(1.0 - cfg.forest_contamination)).over(whole)
    return scores.withColumn("cutoff", cutoff).select(
        "series_id", "ds", "iforest_score", (F.col("iforest_score") > F.col("cutoff")).alias("iforest_raw")
    )


def fit_forest(wide: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The forest of each series as a table of nodes: ``(series_id, tree, node, feature,
    cut, size)``, feature being a place among ``cfg.kpis`` and -1 in a leaf. Node ``i`` has
    children ``2i + 1`` and ``2i + 2``; the root's size is that of the sample. A series with
    a metric that is missing on every day has no forest."""
    kpis = list(cfg.kpis)
    trees, blocks, seed = cfg.forest_trees, max(1, cfg.forest_blocks), cfg.forest_seed

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", kind="stable")
        x, series, block = pdf[kpis].to_numpy(dtype=float), pdf["series_id"].iloc[0], int(pdf["block"].iloc[0])
        mine = [] if np.isnan(x).any() else list(range(block, trees, blocks))
        days = [str(ds) for ds in pdf["ds"]]
        out = [pd.DataFrame({"tree": [], "node": [], "feature": [], "cut": [], "size": []})]
        for tree in mine:
            feature, cut, count = (part[0] for part in grow(x, [f"{seed}|{series}|{tree}"], days, cfg.forest_sample))
            at = np.flatnonzero(count)
            out.append(pd.DataFrame({"tree": tree, "node": at, "feature": feature[at], "cut": cut[at], "size": count[at]}))
        return pd.concat(out).assign(series_id=series)[["series_id", "tree", "node", "feature", "cut", "size"]]

    return _dealt(wide, cfg).applyInPandas(fit, "series_id string, tree int, node int, feature int, cut double, size bigint")


def _dealt(wide: DataFrame, cfg: EngineConfig):
    """The days of each series with its gaps filled, once per block of its trees."""
    kpis = list(cfg.kpis)
    filled = fill_gaps(wide.select("series_id", "ds", *[number(F.col(k)).alias(k) for k in kpis]), kpis)
    blocks = F.sequence(F.lit(0), F.lit(max(1, cfg.forest_blocks) - 1))
    tasks = cfg.forest_tasks or int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = filled.select("*", F.explode(blocks).alias("block"))
    # With an explicit number: grouping alone would keep all blocks of a series in the
    # task that filled its gaps, and adaptive execution would coalesce them again.
    return dealt.repartition(tasks, "series_id", "block").groupBy("series_id", "block")


def score_days(forest: DataFrame, wide: DataFrame, cfg: EngineConfig, cutoffs: DataFrame | None = None) -> DataFrame:
    """What ``score_forest`` returns, for days of ``wide`` by a fitted ``forest``, which is
    not grown again. ``cutoffs`` ``(series_id, cutoff)`` are those of ``forest_cutoffs`` at
    the time of fitting; without them the cut-off is taken among the days scored. A series
    without a forest has days without a score."""
    kpis = list(cfg.kpis)

    def walked(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        out = pdf[["series_id", "ds"]].assign(path=pd.array([None] * len(pdf), dtype="Int64"), size=pd.array([None] * len(pdf), dtype="Int64"))
        x = pdf[kpis].to_numpy(dtype=float)
        if not len(nodes) or not len(pdf) or np.isnan(x).any():
            return out
        size = int(nodes.loc[nodes["node"] == 0, "size"].iloc[0])
        tree = np.unique(nodes["tree"], return_inverse=True)[1]
        shape = (tree.max() + 1, (1 << (height_of(size) + 1)) - 1)
        feature, cut, count = np.full(shape, -1, dtype=np.int64), np.zeros(shape), np.zeros(shape, dtype=np.int64)
        at = (tree, nodes["node"].to_numpy())
        feature[at], cut[at], count[at] = nodes["feature"], nodes["cut"], nodes["size"]
        some = max(1, BATCH // len(x))
        parts = [walk(x, feature[i : i + some], cut[i : i + some], count[i : i + some]) for i in range(0, len(feature), some)]
        return out.assign(path=sum(parts), size=size)

    blocked = forest.withColumn("block", F.col("tree") % max(1, cfg.forest_blocks)).groupBy("series_id", "block")
    found = _dealt(wide, cfg).cogroup(blocked).applyInPandas(walked, "series_id string, ds date, path bigint, size bigint")
    # A block of no trees has no length; a series of no forest has none in any block.
    paths = found.groupBy("series_id", "ds").agg(F.sum("path").alias("path"), F.max("size").alias("size"))
    scores = _scores(paths, cfg)
    if cutoffs is None:
        return _flagged(scores, cfg)
    cut = join_same(scores, cutoffs.select("series_id", "cutoff"), ["series_id"], "left")
    return cut.select("series_id", "ds", "iforest_score", (F.col("iforest_score") > F.col("cutoff")).alias("iforest_raw"))


def forest_cutoffs(scores: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``(series_id, cutoff)``: the score beyond which a day is flagged, of scored days."""
    return scores.groupBy("series_id").agg(F.percentile("iforest_score", F.lit(1.0 - cfg.forest_contamination)).alias("cutoff"))


def with_forest(wide: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The series with the forest's score and flag of each day attached."""
    return join_same(wide, score_forest(wide, cfg), ["series_id", "ds"], "left")
