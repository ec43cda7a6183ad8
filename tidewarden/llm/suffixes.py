"""Repeated passages by a difference cover and blockwise sorting of suffixes.

Two suffixes that agree on ``length`` bytes have, wherever they begin, a pair of cover
samples at the same distance below ``period`` from their starts: that is what a difference
cover is. So the samples' ranks, by their first ``length - period + 1`` bytes, are computed
first, and are all that is needed to tell apart most suffixes: one without a sample whose
rank occurs again is alone. The others, the long ties, are sorted by their first ``length``
bytes, one bucket of suffixes at a time; equal ones then lie side by side, and all but the
first of them repeat.

Ranks and buckets go by 64-bit fingerprints of the bytes, as finding equals needs no
particular order: buckets are even however the texts begin. Documents, in order of their
ids, are strung into groups of a bounded size, numbered in that order. Inside a group a task
settles ties itself, and of each tie sends the first only; so a passage that a third of all
documents hold is one entry per group. Between groups travel sorted runs of fingerprints,
no texts; a bucket answers each group by one bit for each fingerprint, which says that an
earlier group (for ranks: any other) holds it too. Fingerprints are made in ``passes``, one
range of them each, which bounds what is on disk at a time; a task holds one group, or one
bucket.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from ..sources.tables import Steps

LENGTH = 100
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
"""A perfect difference cover: each difference modulo the period occurs once."""
GROUP = 1 << 20
"""Bytes of a group, unless one document has more."""
BUCKET = 1 << 21
"""Fingerprints that a task sorts."""
PASSES = 2
SEGMENT = 1 << 17
"""Bytes whose running totals are in memory at once."""
_BASE = 0x9E3779B97F4A7C15
_GROUPS = "g bigint, ids array<bigint>, ends array<bigint>, data binary"
_KEYS = "bucket int, g bigint, keys binary"
_TOLD = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(2)
def _tables(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value, powers of the base, and their inverses."""
    size = SEGMENT + length
    values = np.random.default_rng(_BASE).integers(0, 2**64, 256, dtype=np.uint64)
    powers = np.cumprod(np.full(size, _BASE, dtype=np.uint64))
    inverse = np.cumprod(np.full(size, pow(_BASE, -1, 2**64), dtype=np.uint64))
    return values, powers, inverse


def fingerprints(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit fingerprints of the ``length`` bytes from each place of ``at`` (ascending)."""
    values, powers, inverse = _tables(length)
    out = np.empty(len(at), dtype=np.uint64)
    total = np.zeros(SEGMENT + length + 1, dtype=np.uint64)
    for start in range(0, len(data), SEGMENT):
        a, b = np.searchsorted(at, (start, start + SEGMENT))
        if a == b:
            continue
        some = data[start : start + SEGMENT + length]
        np.cumsum(values[some] * powers[: len(some)], out=total[1 : len(some) + 1])
        here = at[a:b] - start
        out[a:b] = (total[here + length] - total[here]) * inverse[here]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


class Sorted:
    """Fingerprints in order: the different ones, and which of them each place has."""

    def __init__(self, keys: np.ndarray) -> None:
        order = np.argsort(keys)
        keys = keys[order]
        first = np.ones(len(keys), dtype=bool)
        np.not_equal(keys[1:], keys[:-1], out=first[1:])
        self.starts = np.flatnonzero(first)
        self.keys = keys[self.starts]
        self.order, self.rank = order, np.empty(len(keys), dtype=np.int64)
        self.rank[order] = np.cumsum(first) - 1

    def common(self) -> np.ndarray:
        """Which of the different ones occur more than once."""
        return np.diff(self.starts, append=len(self.order)) > 1

    def firsts(self) -> np.ndarray:
        """The first occurrence of each."""
        return np.minimum.reduceat(self.order, self.starts) if len(self.starts) else self.starts

    def run(self, buckets: Buckets, number: int) -> slice:
        low, high = buckets.bounds(number)
        ends = np.searchsorted(self.keys, np.array([low, min(high, 2**64 - 1)], dtype=np.uint64))
        return slice(ends[0], ends[1] if high < 2**64 else len(self.keys))

    def answered(self, buckets: Buckets, answers: list[dict]) -> np.ndarray:
        """Which of the different ones the buckets' answers mark."""
        out = np.zeros(len(self.keys), dtype=bool)
        for answer in answers:
            run = self.run(buckets, answer["bucket"])
            bits = np.frombuffer(answer["bits"], dtype=np.uint8)
            out[run] = np.unpackbits(bits, count=run.stop - run.start).view(bool)
        return out


class Buckets:
    """Equal ranges of fingerprints."""

    def __init__(self, n_keys: int, passes: int, size: int) -> None:
        self.passes = max(1, passes)
        self.each = max(1, math.ceil(n_keys / self.passes / size))
        self.width = -(-(2**64) // (self.passes * self.each))

    def bounds(self, number: int) -> tuple[int, int]:
        return min(number * self.width, 2**64 - 1), (number + 1) * self.width

    def of_pass(self, n: int) -> range:
        return range(n * self.each, (n + 1) * self.each)


class Group:
    """The texts of a group, strung together."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int) -> None:
        self.data, self.ends, self.length = data, ends, length
        self.end_of = np.repeat(ends, np.diff(ends, prepend=0))

    def samples(self) -> tuple[np.ndarray, Sorted]:
        """Places of the cover samples, and their fingerprints."""
        depth = self.length - PERIOD + 1
        at = (np.arange(0, len(self.data), PERIOD)[:, None] + np.array(COVER)).ravel()
        at = at[at < len(self.data)]
        at = at[at + depth <= self.end_of[at]]
        return at, Sorted(fingerprints(self.data, at, depth))

    def suffixes(self, ranks: Buckets, answers: list[dict]) -> tuple[np.ndarray, Sorted]:
        """Places of the long ties, which have a sample whose rank occurs again, here or in
        another group, and their fingerprints."""
        at, found = self.samples()
        tied = at[(found.common() | found.answered(ranks, answers))[found.rank]]
        mark = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(mark, np.maximum(tied - PERIOD + 1, 0), 1)
        mark[tied + 1] -= 1
        places = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        places = places[places + self.length <= self.end_of[places]]
        return places, Sorted(fingerprints(self.data, places, self.length))

    def told(self, ranks: Buckets, answers: list[dict], tails: Buckets, earlier: list[dict]) -> list[tuple]:
        """Per document: its bytes, those removed, their runs, and the rest's digest."""
        at, found = self.suffixes(ranks, answers)
        again = np.ones(len(at), dtype=bool)
        again[found.firsts()] = found.answered(tails, earlier)
        again = at[again]
        mark = np.zeros(len(self.data) + 1, dtype=np.int32)
        mark[again] += 1
        mark[again + self.length] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        out, start = [], 0
        for end in self.ends.tolist():
            mine = gone[start:end]
            n = int(mine.sum())
            runs = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(bool(n) and bool(mine[0]))
            rest = self.data[start:end][~mine] if n else self.data[start:end]
            out.append((end - start, n, runs, hashlib.sha256(rest.tobytes()).hexdigest()))
            start = end
        return out


def _stringer(group: int) -> Callable:
    def string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            columns += [pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(texts), 1)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["g", "ids", "ends", "data"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if texts and held + len(text) > group:
                    yield row()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(id_)
                texts.append(text)
                held += len(text)
        if texts:
            yield row()

    return string


def _groups(batch: pa.RecordBatch, length: int) -> Iterator[tuple[dict, Group]]:
    at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    for i in range(batch.num_rows):
        data = np.frombuffer(zstandard.decompress(at["data"][i].as_buffer()), dtype=np.uint8)
        ends = np.array(at["ends"][i].as_py(), dtype=np.int64)
        yield {k: v[i].as_py() or [] for k, v in at.items() if k not in ("data", "g")} | {"g": at["g"][i].as_py()}, Group(data, ends, length)


def _sender(length: int, ranks: Buckets, tails: Buckets | None, n: int) -> Callable:
    """Runs of each group's fingerprints, by bucket of the ``n``-th pass: those of its
    samples, or, with ``tails``, of its long ties."""
    buckets = tails or ranks

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, group in _groups(batch, length):
                _, found = group.suffixes(ranks, row["ties"]) if tails else group.samples()
                runs = [(b, found.keys[found.run(buckets, b)]) for b in buckets.of_pass(n)]
                runs = [(b, run.tobytes()) for b, run in runs if len(run)]
                if not runs:
                    continue
                columns = [pa.array([b for b, _ in runs], pa.int32()), pa.array([row["g"]] * len(runs), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([run for _, run in runs], pa.binary())], names=["bucket", "g", "keys"])

    return send


def _sorter(earlier: bool) -> Callable:
    """For each group of a bucket, which of its keys an earlier group, or else any other
    group, holds too. A group sends a key once."""

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g", kind="stable")
        runs = [np.frombuffer(run, dtype=np.uint64) for run in pdf["keys"]]
        found = Sorted(np.concatenate(runs))
        marked = found.common()[found.rank]
        if earlier:
            marked[found.firsts()] = False
        parts = np.split(marked, np.cumsum([len(run) for run in runs])[:-1])
        bits = [np.packbits(part).tobytes() if part.any() else None for part in parts]
        return pdf[["bucket", "g"]].assign(bits=bits).dropna(subset="bits")

    return sort


def _teller(length: int, ranks: Buckets, tails: Buckets) -> Callable:
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, group in _groups(batch, length):
                told = group.told(ranks, row["ties"], tails, row["earlier"])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(row["ids"], pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*told), kinds)]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return tell


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each job's shuffle files go when it ends, as its result is a table."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


def _answers(groups: DataFrame, step: Steps, name: str, length: int, ranks: Buckets, tails: Buckets | None = None) -> DataFrame:
    """``(g, name)``: the answers of all buckets to each group."""
    found = None
    for n in range(ranks.passes):
        sent = groups.mapInArrow(_sender(length, ranks, tails, n), _KEYS)
        told = sent.groupBy("bucket").applyInPandas(_sorter(tails is not None), "bucket int, g bigint, bits binary")
        told = step(told, f"{name}-{n}")
        found = told if found is None else found.unionAll(told)
    return found.groupBy("g").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    group: int = GROUP,
    bucket: int = BUCKET,
    passes: int = PASSES,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``: what
    is left of its UTF-8 bytes without those covered by ``length`` bytes that also start
    earlier, in a smaller id or before in the same text. Whether they do is judged on the
    whole input; matches overlap freely and never cross documents.

    Null texts are empty ones. Null ids come after all others, and rows of equal ids in
    order of a hash of their texts; of repeated rows, one is the first. ``length`` is at
    least twice ``PERIOD``. Other columns are not read; an empty input gives an empty table.
    Two different strings that share a 64-bit fingerprint would be taken for one.
    """
    if length < 2 * PERIOD:
        raise ValueError(f"length must be at least {2 * PERIOD}")
    spark = docs.sparkSession
    step = new_steps(spark, "suffixes")
    data = F.encode(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "UTF-8")
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), data.alias("data"))
    size = read.agg(F.sum(F.octet_length("data"))).first()[0]
    if size is None:
        return spark.createDataFrame([], _TOLD).withColumnRenamed("doc_id", id_col)
    with _shuffles_freed(spark):
        order = [F.asc_nulls_last("id"), F.xxhash64("data")]
        parts = max(1, math.ceil(size / (16 * max(group, 1 << 20))), min(spark.sparkContext.defaultParallelism, math.ceil(size / group)))
        placed = read.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        groups = step(placed.mapInArrow(_stringer(group), _GROUPS), "groups")
        ranks = Buckets(size * len(COVER) // PERIOD, passes, bucket)
        texts = groups.select("g", "ends", "data")
        ties = step(_answers(texts, step, "ties", length, ranks), "ties")
        # Texts that all repeat send four times as many, which a task holds as well.
        tails = Buckets(size // 4, passes, bucket)
        earlier = _answers(texts.join(ties, "g", "left"), step, "earlier", length, ranks, tails)
        whole = groups.join(ties, "g", "left").join(step(earlier, "earlier"), "g", "left")
        told = step(whole.mapInArrow(_teller(length, ranks, tails), _TOLD), "told")
    return told.withColumnRenamed("doc_id", id_col)
