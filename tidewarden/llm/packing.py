"""Best-fit packing of tokenised documents, repacked until a bound certifies it.

Pieces are dealt to partitions of a bounded number of rows, and each partition is packed
best-fit decreasing by one task. Dual-feasible functions give a lower bound of the
sequences that a partition needs; one that meets it is certified: no packing of its pieces
needs fewer, so its sequences are settled, but for the least filled one. The others have a
gap: all their sequences that are not full are pooled with those, dealt anew, so that
partitions exchange documents, and packed again, until the whole meets its own bound. Once
no partition has a gap, or their exchange saves nothing, what is lost lies between the
partitions, and the open sequences of all are pooled. A round that saves nothing is not
taken. Rounds are tables; the driver sees a row of counts per round and the histogram of
piece lengths, which the capacity bounds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from .wordbpe import word_tokenizer

CAPACITY = 2048
END = 0
"""Id after every document."""
PER_PARTITION = 8_192
"""Pieces that one task packs."""
ROUNDS = 6
TEXTS = 500
"""Documents that a worker tokenises at once."""
PIECES = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", part bigint, bin bigint, offset bigint, fill bigint, bins bigint, bound bigint, least bigint"


def dff_bound(count: np.ndarray) -> int:
    """A lower bound of the sequences that ``count[length]`` pieces need, as the largest
    of several dual-feasible functions: rounding to multiples of 1/(k+1), and, for each
    threshold, lengths near the capacity counted whole and short ones not at all."""
    capacity = len(count) - 1
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, 33):
        scaled = (k + 1) * size
        units = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)
        best = max(best, -(-int((count * units).sum()) // (capacity * k)))
    below = np.concatenate([[0], np.cumsum(count * size)])
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    cut = np.arange(1, capacity // 2 + 1)
    middle = below[capacity - cut + 1] - below[cut]
    return max(best, int((above[capacity - cut + 1] + -(-middle // capacity)).max(initial=0)))


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first into the fullest bin that has room.
    Open bins wait by their free room; the bits of a number say which rooms exist."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = open_[room].pop()
            if not open_[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_, n = capacity, n, n + 1
        bins[i], offsets[i] = bin_, capacity - room
        if room > length:
            open_[room - length].append(bin_)
            rooms |= 1 << (room - length)
    return bins, offsets


def _packer(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        lengths = pdf["length"].to_numpy(dtype=np.int64)
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        bound = dff_bound(np.bincount(lengths, minlength=capacity + 1))
        return pdf.assign(bin=bins, offset=offsets, fill=fill[bins], bins=len(fill), bound=bound, least=int(fill.argmin()))

    return pack


def _open(capacity: int, every: bool) -> Column:
    """The sequences to pack again: those not full of partitions with a gap, and the least
    filled one of each certified partition; or all that are not full."""
    not_full = F.col("fill") < capacity
    gap = F.col("bins") > F.col("bound")
    return not_full if every else not_full & (gap | (F.col("bin") == F.col("least")))


def _cutter(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(ids), TEXTS):
                rows: list[tuple] = []
                for id_, data in zip(ids[i : i + TEXTS], tokenizer.encode(texts[i : i + TEXTS])):
                    data += end
                    for n, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        rows.append((id_, n, at // 4, len(part) // 4, zlib.crc32(part), part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=list(_NAMES)
                )

    return cut


_NAMES = ("id", "piece", "start", "length", "ids_crc32", "ids")
_ARROW = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


def token_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, ids)``: the documents' ids, each followed
    by id 0, cut where longer than the capacity. ``ids`` are little-endian 32-bit
    numbers. A null text is an empty one: a single id 0."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text"))
    return read.mapInArrow(_cutter(path, capacity), PIECES + ", ids binary")


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    per_partition: int = PER_PARTITION,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``
    and ``least_sequences``, below which no packing of all pieces can go: if as many
    sequences occur, the packing is certified as the best there is.

    Every document is packed whole unless it is longer than ``capacity``. A null or empty
    text is a piece of one id; repeated rows are packed as often as they come; a null id
    is carried along. Other columns of the input are not read. An empty input gives an
    empty table.
    """
    step = new_steps(docs.sparkSession, "packing")
    pool = step(token_pieces(docs, path, id_col, text_col, capacity).drop("ids"), "pieces")
    lengths = pool.groupBy("length").count().collect()  # at most ``capacity`` rows
    count = np.zeros(capacity + 1, dtype=np.int64)
    for row in lengths:
        count[row["length"]] = row["count"]
    bound, waiting = dff_bound(count), int(count.sum())

    def pack(pool: DataFrame, waiting: int, turn: int) -> tuple[DataFrame, int]:
        parts = max(1, math.ceil(waiting / per_partition))
        part = F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts))
        dealt = pool.select("id", "piece", "start", "length", "ids_crc32", part.alias("part"))
        packed = step(dealt.groupBy("part").applyInPandas(_packer(capacity), PACKED), f"round-{turn}")
        packed = packed.withColumn("turn", F.lit(turn))
        return packed, packed.where(F.col("offset") == 0).count()

    whole, total = pack(pool, waiting, 0)
    every = False
    for turn in range(1, max(1, rounds)):
        if total <= bound:
            break
        every = every or whole.where(F.col("bins") > F.col("bound")).isEmpty()
        again = _open(capacity, every)
        rest = whole.where(again)
        waiting, freed = rest.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        packed, used = pack(rest, waiting, turn)
        if used < freed:
            whole, total = whole.where(~again).unionAll(packed), total - freed + used
        elif every:
            break
        else:
            every = True
    sequence = F.expr("(CAST(turn AS BIGINT) << 56) | (part << 20) | bin")
    return whole.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        sequence.alias("sequence_id"),
        "offset",
        F.lit(bound).cast("bigint").alias("least_sequences"),
    )


def sequences(
    docs: DataFrame, packed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``(sequence_id, ids)``: the packed ids themselves, by ``packed`` of the same
    documents, whose ids must be distinct. A sequence gathers its capacity at most."""
    pieces = token_pieces(docs, path, id_col, text_col, capacity).select(F.col("id").alias(id_col), "piece", "ids")
    placed = packed.select(id_col, "piece", "sequence_id", "offset").join(pieces, [id_col, "piece"])
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    one = placed.groupBy("sequence_id").agg(inside.alias("inside"))
    ids = F.aggregate("inside", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return one.select("sequence_id", ids.alias("ids"))
