"""Hard negatives by an STR-packed R-tree.

Rows are cut into slabs by their most spread coordinate and sorted by the next inside
each, so that a tile is a run of ``TILE`` rows that lie close together. Each tile is packed
by one task into the lower levels of the tree: leaves in sort-tile-recursive order, boxes
over them, boxes over those. The tiles' own boxes are a table, the tree's upper level.

A box bounds the inner product with an anchor from both sides, coordinate by coordinate.
A search first meets an anchor's own tile, whose k-th best is a floor for the whole; then
the table of tile boxes, where those outside the score window or strictly below the floor
are pruned; then, in one task per tile and some hundreds of anchors, the tile's boxes from a
best-first queue until the best left is strictly below the k-th. Scores are integers, so
pruning is exact, ties included, and results equal a comparison with all rows.

No task holds more than a tile and a chunk of anchors, however many rows are alike: rows
that tie on a coordinate are dealt out by a hash. Anchors meet tiles by an equality join.
"""

from __future__ import annotations

import heapq
import io
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from ..sources.tables import Steps
from .vectors import equal_length

TILE = 8_192
"""Rows of a tile."""
LEAF = 128
FANOUT = 8
"""Rows of a leaf, and children of a box."""
CUTS = 4
"""Coordinates that leaves are tiled by."""
CHUNK = 512
"""Anchors that a task answers for."""
SPREAD = 32
"""Coordinates among which the most spread are sought for tiles; this decides speed only."""
LONGEST = 2**63 - 1
FOUND = "q bigint, id bigint, score bigint"


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer arrays, exact: by floating point where
    every partial sum fits into its 53 bits, else in 64-bit integers."""
    kind = _exact(a, b)
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    most = [int(np.abs(x).max(initial=0)) for x in (a, b)]
    return np.float64 if most[0] * most[1] * max(1, a.shape[1]) < 2**53 else np.int64


def _str_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Rows in sort-tile-recursive order by the most spread coordinates."""
    axes = np.argsort(-x.var(axis=0), kind="stable")[: min(CUTS, x.shape[1])]
    runs = [np.arange(len(x))]
    for i, axis in enumerate(axes):
        cut = []
        for run in runs:
            run = run[np.argsort(x[run, axis], kind="stable")]
            pages = max(1, math.ceil(len(run) / leaf))
            slabs = math.ceil(pages ** (1 / (len(axes) - i)))
            size = math.ceil(pages / slabs) * leaf
            cut += [run[at : at + size] for at in range(0, len(run), size)]
        runs = cut
    return np.concatenate(runs)


class Tree:
    """The part of the R-tree over one tile. Nodes are numbered from the leaves up, and
    the last is the root; ``first`` and ``last`` are a node's rows (leaf) or nodes."""

    PARTS = ("ids", "labels", "x", "low", "high", "first", "last")

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        order = _str_order(x, LEAF)
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        first = np.arange(0, len(x), LEAF)
        lows, highs = [np.minimum.reduceat(self.x, first)], [np.maximum.reduceat(self.x, first)]
        firsts, lasts, base = [first], [np.append(first[1:], len(x))], 0
        while len(lows[-1]) > 1:
            at = np.arange(0, len(lows[-1]), FANOUT)
            firsts.append(base + at)
            lasts.append(base + np.append(at[1:], len(lows[-1])))
            base += len(lows[-1])
            lows, highs = [*lows, np.minimum.reduceat(lows[-1], at)], [*highs, np.maximum.reduceat(highs[-1], at)]
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.first, self.last = np.concatenate(firsts), np.concatenate(lasts)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{p: getattr(self, p) for p in self.PARTS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree, arrays = cls.__new__(cls), np.load(io.BytesIO(data), allow_pickle=False)
        for part in cls.PARTS:
            setattr(tree, part, arrays[part])
        return tree

    def best(
        self, x: np.ndarray, query: np.ndarray, bounds: tuple[list, list], mask: np.ndarray, windows: list[tuple[int, int, int]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window ``(low, high, floor)`` the first ``k`` rows of ``mask`` with a
        score inside it and no lower than its floor, by score and then by smaller id. ``x``
        are the tree's vectors, as numbers in which products with ``query`` are exact."""
        least, most = bounds
        none = np.zeros(0, dtype=np.int64)
        found = [(none, none)] * len(windows)
        bars, highs = [max(low, floor) for low, _, floor in windows], [high for _, high, _ in windows]
        lowest, highest = min(bars), max(highs)
        root, leaves = len(self.low) - 1, -(-len(self.ids) // LEAF)
        queue = [(-most[root], root)]
        while queue:
            top, node = heapq.heappop(queue)
            if -top < lowest:
                break
            a, b = self.first[node], self.last[node]
            if node >= leaves:
                for child in range(a, b):
                    if most[child] >= lowest and least[child] <= highest:
                        heapq.heappush(queue, (-most[child], child))
                continue
            scores = x[a:b] @ query
            fits = np.flatnonzero(mask[a:b] & (scores >= lowest) & (scores <= highest))
            if not len(fits):
                continue
            scores, ids = scores[fits].astype(np.int64), self.ids[a:b][fits]
            for w, (bar, high) in enumerate(zip(bars, highs)):
                own = (scores >= bar) & (scores <= high)
                if own.any():
                    all_ids, all_scores = np.concatenate([found[w][0], ids[own]]), np.concatenate([found[w][1], scores[own]])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    found[w] = all_ids[order], all_scores[order]
                    if len(order) == k:
                        bars[w] = max(bar, int(found[w][1][-1]))
            lowest = min(bars)
        return found


def box_bounds(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query (rows) with any point of each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.int64)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """A tile's rows as its tree, and its box."""
    pdf = pdf.sort_values("u", kind="stable")
    tree = Tree(pdf["id"].to_numpy(np.int64), pdf["label"].to_numpy(dtype=str), _matrix(pdf["vector"]))
    row = (int(pdf["tile"].iloc[0]), tree.low[-1].tolist(), tree.high[-1].tolist(), tree.dump())
    return pd.DataFrame([row], columns=["tile", "low", "high", "tree"])


def _meet(boxes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The tiles that may hold what an anchor asks for."""
    none = pd.DataFrame({"a": np.zeros(0, np.int64), "tile": np.zeros(0, np.int64)})
    if not len(boxes) or not len(asked):
        return none
    least, most = box_bounds(_matrix(boxes["low"]), _matrix(boxes["high"]), _matrix(asked["vector"]))
    a, t = np.nonzero((most >= asked["low"].to_numpy()[:, None]) & (least <= asked["high"].to_numpy()[:, None]))
    return pd.DataFrame({"a": asked["a"].to_numpy()[a], "tile": boxes["tile"].to_numpy()[t]})


def _searcher(k: int, same: bool):
    def search(tiles: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64),) * 3]
        if len(tiles) and len(asked):
            tree = Tree.load(tiles["tree"].iloc[0])
            # The windows of one anchor are sought together.
            asked = asked.sort_values("a", kind="stable")
            starts = np.flatnonzero(asked["a"].diff().ne(0))
            queries = _matrix(asked["vector"].iloc[starts])
            kind = _exact(tree.x, queries)
            x, points = tree.x.astype(kind), queries.astype(kind)
            least, most = box_bounds(tree.low, tree.high, queries)
            q, labels, owns = (asked[c].to_numpy() for c in ("q", "label", "own"))
            windows = list(zip(*(asked[c].tolist() for c in ("low", "high", "floor"))))
            masks = {label: (tree.labels == label) == same for label in set(labels)}
            for i, (at, end) in enumerate(zip(starts, [*starts[1:], len(asked)])):
                mask = masks[labels[at]] & (tree.ids != owns[at]) if same else masks[labels[at]]
                best = tree.best(x, points[i], (least[i].tolist(), most[i].tolist()), mask, windows[at:end], k)
                found += [(np.full(len(ids), q[at + w]), ids, scores) for w, (ids, scores) in enumerate(best)]
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("q", "id", "score"), zip(*found))})

    return search


class PackedTree:
    """The R-tree over ``(id, label, vector)``, vectors being integers of one length.
    ``rows`` are those given, each with its ``tile``."""

    def __init__(self, rows: DataFrame, width: int, step: Steps, tile: int = TILE) -> None:
        self.step, self.tile = step, max(1, tile)
        dealt = rows.withColumn("u", F.monotonically_increasing_id())
        rows = step(dealt.withColumn("u", F.xxhash64("u")), "rows")
        n = rows.count()
        spark, tiles = rows.sparkSession, max(1, math.ceil(n / self.tile))
        spread = rows.agg(*[F.var_pop(F.col("vector")[i]).alias(str(i)) for i in range(min(width, SPREAD))]).first()
        first, second = (sorted(range(len(spread)), key=lambda i: (-(spread[i] or 0.0), i)) * 2)[:2]
        # A fraction from the row's hash parts rows that tie on the coordinate.
        key = lambda i: F.col("vector")[i] + (F.col("u") / F.lit(2.0**64) + 0.5)
        slabs = math.ceil(math.sqrt(tiles))
        at = [i / slabs for i in range(1, slabs)]
        cuts = rows.agg(F.percentile_approx(key(first), at, max(10_000, 10 * slabs)).alias("cuts")).first()["cuts"] if at else []
        cuts = np.array(cuts or [], dtype=np.float64)

        @F.pandas_udf("int")
        def slab(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(cuts, values.to_numpy(), side="right"), dtype="int32")

        parts = max(1, math.ceil(tiles / 16), min(tiles, spark.sparkContext.defaultParallelism))
        placed = rows.withColumns({"slab": slab(key(first)), "place": key(second)})
        ranged = placed.repartitionByRange(parts, "slab", "place").sortWithinPartitions("slab", "place")
        # Numbers run on inside a partition and start at another multiple of 2**33 in each.
        run = F.shiftright(F.monotonically_increasing_id(), 33) * (1 << 33) + F.floor(
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) / self.tile
        )
        self.rows = step(ranged.drop("slab", "place").withColumn("tile", run), "tiled")
        schema = "tile bigint, low array<bigint>, high array<bigint>, tree binary"
        self.tiles = step(self.rows.select("id", "label", "vector", "u", "tile").groupBy("tile").applyInPandas(_pack, schema), "tiles")
        self.n_tiles = self.tiles.count()

    def _search(self, asked: DataFrame, met: DataFrame, k: int, same: bool) -> DataFrame:
        """The best ``k`` in each tile of ``met`` ``(a, tile, chunk)`` for each query."""
        wanted = met.select("tile", F.col("chunk").alias("part")).distinct()
        needed = self.tiles.select("tile", "tree").join(wanted, "tile").groupBy("tile", "part")
        met = met.select("a", F.col("tile").alias("at"), F.col("chunk").alias("part"))
        queries = met.join(asked.drop("chunk", "tile"), "a").groupBy("at", "part")
        return needed.cogroup(queries).applyInPandas(_searcher(k, same), FOUND)

    @staticmethod
    def _ranked(found: DataFrame, k: int) -> DataFrame:
        order = W.partitionBy("q").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def best(self, queries: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """``(q, id, score, rank)``: the first ``k`` rows of a label equal to the query's
        (``same``; its ``own`` id left out) or another, with a score in its window.
        ``queries`` has ``q, label, vector, own, low, high``, the ``tile`` it lies in, and
        ``a``, its anchor's number."""
        chunks = max(1, math.ceil(queries.select("a").distinct().count() / CHUNK))
        chunk = F.pmod(F.xxhash64("a"), F.lit(chunks)).alias("chunk")
        lowest = F.lit(-LONGEST)
        start = self.step(queries.select("*", lowest.alias("floor"), chunk), f"{name}-queries")
        near = self._ranked(self._search(start, start.select("a", "tile", "chunk").distinct(), k, same), k)
        floors = self.step(near.where(F.col("rank") == k).select("q", F.col("score").alias("bar")), f"{name}-floors")
        asked = start.drop("floor").join(floors, "q", "left").withColumn("floor", F.coalesce("bar", lowest)).drop("bar")
        asked = self.step(asked, f"{name}-asked")
        blocks = max(1, math.ceil(self.n_tiles / 1024))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
        boxes = self.tiles.select("tile", "low", "high", F.pmod(F.xxhash64("tile"), F.lit(blocks)).alias("block"))
        boxes = boxes.withColumn("chunk", every(chunks))
        posed = asked.groupBy("a", "vector", "chunk").agg(
            F.min(F.greatest("low", "floor")).alias("low"), F.max("high").alias("high")
        ).withColumn("block", every(blocks))
        key = ["block", "chunk"]
        met = boxes.groupBy(*key).cogroup(posed.groupBy(*key)).applyInPandas(_meet, "a bigint, tile bigint")
        met = self.step(met.select("a", "tile", chunk), f"{name}-met")
        return self.step(self._ranked(self._search(asked, met, k, same), k), f"{name}-found")


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    tile: int = TILE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for
    each row where ``anchors`` holds, its best ``positives`` other rows of the same label
    by inner product, and for each of these the best ``negatives`` rows of other labels
    whose score is between ``least`` percent of the positive's and the positive's own.
    Ties go to the smaller id; what has fewer gets all.

    ``vector_col`` holds integers (see ``vectors.floored``), whose inner products must fit
    into 64 bits. Rows with a null id, label or vector, or a null component, take no part.
    Vectors of different length are compared as if zeros followed the shorter. A row that
    shares an anchor's id is not another row; repeated rows otherwise count as often as
    they come, and equal anchors are one. A positive with a negative score has no
    negatives. Other columns are not read; an empty input gives an empty table.
    """
    spark = rows.sparkSession
    step = new_steps(spark, "rtree")
    vector = F.col(f"`{vector_col}`").cast("array<bigint>")
    read = rows.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        vector.alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    read, width = equal_length(step(read, "read"), "vector")
    columns = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not width:
        return spark.createDataFrame([], columns)
    tree = PackedTree(read, width, step, tile)

    number = F.monotonically_increasing_id()
    chosen = tree.rows.where("anchor").groupBy("id", "label", "vector").agg(F.min("tile").alias("tile"))
    asked = step(chosen.withColumnRenamed("id", "own").withColumn("a", number), "anchors")
    open_ = {"low": F.lit(-LONGEST), "high": F.lit(LONGEST)}
    first = tree.best(asked.withColumns({"q": F.col("a"), **open_}), positives, True, "positives")
    # The ceiling of a percentage, taken apart so that it does not overflow.
    lowest = F.expr(f"{least} * (score DIV 100) + ({least} * (score % 100) + 99) DIV 100").alias("low")
    pairs = first.where("score >= 0").select(F.col("q").alias("a"), F.col("id").alias("positive_id"), lowest, F.col("score").alias("high"))
    pairs = step(pairs.join(asked, "a").withColumn("q", number), "pairs")
    second = tree.best(pairs.drop("positive_id"), negatives, False, "negatives")
    named = pairs.select("q", F.col("own").alias("anchor_id"), "positive_id", F.col("high").alias("positive_score"))
    return second.join(named, "q").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
