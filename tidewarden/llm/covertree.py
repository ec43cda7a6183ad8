"""Product codes of vectors by Lloyd's rounds over cover trees.

Vectors are cut into equal parts; each part position has a codebook, refined by rounds of
assigning every part to its nearest entry and averaging. Rows are taken in blocks of a
bounded size, inside the partitions they come in, and each block gets one cover tree for
each part position: a node's children have half its reach, lie apart by more than that, and
include its own centre. The points of a node are a run of the tree's order, so that running
totals give their count and sum. A round takes a node whole if the triangle inequality says
that all its points have the same nearest entry as its centre; nodes for which it does not
are opened, down to leaves, whose points are compared one by one. Equal parts are one point
with a weight, so copies cost nothing.

Distances are integers, so codes equal those of plain comparisons. Trees are built once and
written as a table; each round reads them, and a task returns one row per entry. The driver
sees codebooks only, whose size the parameters bound.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import join_same
from ..sources.shared import new_steps
from .vectors import equal_length

PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK = 4_096
"""Rows of a block."""
LEAF = 48
"""Points below which a node is not divided."""
SLACK = 1e-9
"""Share of a distance that rounding might cost; nearer calls are made by the points."""


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two integer arrays."""
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


class CoverTree:
    """Over the rows of ``x``. ``point`` names each row's point in tree order."""

    ARRAYS = ("points", "weight", "total", "point", "centre", "reach", "start", "stop", "first", "last")

    def __init__(self, x: np.ndarray) -> None:
        points, where, weight = np.unique(x, axis=0, return_inverse=True, return_counts=True)
        order = np.arange(len(points))
        # Per node: its centre (a point), the run of its points, and its children.
        centre, start, stop, reach, first, last = [0], [0], [len(points)], [], [], []
        at = 0
        while at < len(centre):
            a, b = start[at], stop[at]
            run = order[a:b].copy()
            apart = ((points[run] - points[centre[at]]) ** 2).sum(axis=1)
            reach.append(float(np.sqrt(apart.max())))
            first.append(len(centre))
            if b - a > LEAF and reach[-1] > 0:
                limit, placed, here = apart.max() / 4, a, centre[at]
                while len(run):
                    apart = ((points[run] - points[here]) ** 2).sum(axis=1)
                    inside = apart <= limit
                    own = run[inside]
                    order[placed : placed + len(own)] = own
                    centre.append(here)
                    start.append(placed)
                    stop.append(placed + len(own))
                    placed += len(own)
                    run = run[~inside]
                    here = run[0] if len(run) else 0
            last.append(len(centre))
            at += 1
        place = np.empty(len(points), dtype=np.int64)
        place[order] = np.arange(len(points))
        self.points, self.point, weight = points[order], place[where.ravel()], weight[order]
        self.weight = np.concatenate([[0], np.cumsum(weight)])
        zero = np.zeros((1, x.shape[1]), dtype=np.int64)
        self.total = np.concatenate([zero, np.cumsum(self.points * weight[:, None], axis=0)])
        self.centre = points[centre]
        self.reach = np.array(reach)
        self.start, self.stop, self.first, self.last = (np.array(v) for v in (start, stop, first, last))

    def assign(self, entries: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows nearest to each entry, as their number and their sum; ties go to the entry
        first in order. ``codes`` receives the entry of each point."""
        # Equal entries would leave every point in doubt: the first stands for all.
        _, own = np.unique(entries, axis=0, return_index=True)
        own = np.sort(own)
        some = entries[own]
        count = np.zeros(len(entries), dtype=np.int64)
        total = np.zeros(entries.shape, dtype=np.int64)
        weight = np.diff(self.weight)
        nodes = np.zeros(1, dtype=np.int64)
        while len(nodes):
            apart = squared(self.centre[nodes], some)
            best = apart.argmin(axis=1)
            if len(some) > 1:
                two = np.sqrt(np.partition(apart, 1, axis=1)[:, :2])
                sure = two[:, 1] - two[:, 0] - 2 * self.reach[nodes] > SLACK * (two[:, 1] + self.reach[nodes] + 1)
            else:
                sure = np.ones(len(nodes), dtype=bool)
            a, b, e = self.start[nodes[sure]], self.stop[nodes[sure]], own[best[sure]]
            np.add.at(count, e, self.weight[b] - self.weight[a])
            np.add.at(total, e, self.total[b] - self.total[a])
            if codes is not None:
                for i, j, entry in zip(a, b, e):
                    codes[i:j] = entry
            open_ = nodes[~sure]
            leaf = self.first[open_] == self.last[open_]
            if leaf.any():
                at = _runs(self.start[open_[leaf]], self.stop[open_[leaf]])
                e = own[squared(self.points[at], some).argmin(axis=1)]
                np.add.at(count, e, weight[at])
                np.add.at(total, e, self.points[at] * weight[at][:, None])
                if codes is not None:
                    codes[at] = e
            nodes = _runs(self.first[open_[~leaf]], self.last[open_[~leaf]])
        return count, total


def _runs(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    size = stop - start
    if not len(size):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(start - ends + size, size)


def dump(trees: list[CoverTree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{i}-{name}": getattr(t, name) for i, t in enumerate(trees) for name in CoverTree.ARRAYS})
    return out.getvalue()


def load(data: bytes, parts: int) -> list[CoverTree]:
    arrays, trees = np.load(io.BytesIO(data), allow_pickle=False), []
    for i in range(parts):
        tree = CoverTree.__new__(CoverTree)
        for name in CoverTree.ARRAYS:
            setattr(tree, name, arrays[f"{i}-{name}"])
        trees.append(tree)
    return trees


def _grower(parts: int):
    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK):
                some = pdf.iloc[at : at + BLOCK]
                x = np.stack(some["vector"].to_numpy()).astype(np.int64)
                trees = [CoverTree(part) for part in np.split(x, parts, axis=1)]
                row = ([some["id"].to_list()], [some["label"].to_list()], [dump(trees)])
                yield pd.DataFrame(dict(zip(("ids", "labels", "trees"), row)))

    return grow


def _adder(books: np.ndarray):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(books.shape[:2], dtype=np.int64)
        total = np.zeros(books.shape, dtype=np.int64)
        for pdf in batches:
            for data in pdf["trees"]:
                for part, tree in enumerate(load(data, len(books))):
                    n, sums = tree.assign(books[part])
                    count[part] += n
                    total[part] += sums
        part, entry = np.nonzero(count)
        yield pd.DataFrame({"part": part, "entry": entry, "n": count[part, entry], "sums": list(total[part, entry])})

    return add


def _coder(books: np.ndarray):
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, labels, data in zip(pdf["ids"], pdf["labels"], pdf["trees"]):
                error = np.zeros(len(ids), dtype=np.int64)
                codes = np.zeros((len(ids), len(books)), dtype=np.uint8)
                for part, tree in enumerate(load(data, len(books))):
                    own = np.zeros(len(tree.points), dtype=np.int64)
                    tree.assign(books[part], own)
                    error += ((tree.points - books[part][own]) ** 2).sum(axis=1)[tree.point]
                    codes[:, part] = own[tree.point]
                yield pd.DataFrame(
                    {"id": pd.array(list(ids), dtype="Int64"), "label": list(labels), "code": [c.tobytes().hex() for c in codes], "error": error}
                )

    return code


def product_codes(
    rows: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` for every row with a vector.

    ``vector_col`` holds integers (see ``vectors.floored``) whose squared distances must
    fit into 64 bits. Null vectors and those with a null component are left out; shorter
    ones are taken as if zeros followed them, up to a multiple of ``parts``. Codebooks
    start as the parts of the ``entries`` (256 at most) smallest ids, null ids last and
    equal ids in order of their vectors; with fewer rows they are shorter. Averages are
    rounded down, and an entry that nothing is nearest to stays. ``code`` has two hex
    digits per part, ``error`` is the squared distance to what it stands for, and
    ``label_error`` the sum of the errors of its label, nulls being one label. Repeated
    rows are returned as often as they come, rows with a null id too. Other columns are
    not read; an empty input gives an empty table.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = rows.sparkSession
    step = new_steps(spark, "covertree")
    read = rows.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<bigint>").alias("vector"),
    ).where("vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    read, width = equal_length(step(read, "read"), "vector", parts)
    if not width:
        return spark.createDataFrame([], f"{id_col} bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    start = read.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    books = np.array([r["vector"] for r in start], dtype=np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()

    schema = "ids array<bigint>, labels array<string>, trees binary"
    blocks = step(read.mapInPandas(_grower(parts), schema), "blocks")
    for _ in range(rounds):
        found = blocks.select("trees").mapInPandas(_adder(books), "part int, entry int, n bigint, sums array<bigint>")
        sums = [F.sum(F.col("sums")[i]) for i in range(width // parts)]
        merged = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*sums).alias("sums"))
        for r in merged.collect():  # at most parts x entries rows
            books[r["part"], r["entry"]] = np.array(r["sums"], dtype=np.int64) // r["n"]
    coded = step(blocks.mapInPandas(_coder(books), "id bigint, label string, code string, error bigint"), "coded")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    totals = step(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "totals")
    return join_same(coded, totals, ["label"], "left").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
