"""Token counts that follow edits, by a segment tree over each document's pre-tokens.

A document is cut into leaves of whole pre-tokens, at places between something and the
white space after it, where the pattern always ends a token. A segment tree holds the
characters and tokens under every node: an edit finds its leaves by descending the
characters, only these (and a neighbour, where the edit touches a leaf's end) are encoded
again, and the sums on the way to the root are updated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytebpe import _CUT, encode_text, encoding

LEAF = 256
"""Characters of a leaf, before the next place to cut."""
MOST = 4 * LEAF
"""Characters beyond which an edited region is cut into leaves anew."""
EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"


def leaves_of(text: str) -> list[str]:
    parts, at = [], 0
    while len(text) - at > LEAF and (cut := _CUT.search(text, at + LEAF)):
        parts.append(text[at : cut.start()])
        at = cut.start()
    return [*parts, text[at:]]


class CountTree:
    """Sums in heap order: node ``i`` has children ``2i`` and ``2i + 1``, the root is 1,
    and the leaves are the second half."""

    def __init__(self, count: Callable[[str], int], chars: list[int], tokens: list[int]) -> None:
        self.count, self.chars, self.tokens = count, chars, tokens
        self.recoded = 0

    @classmethod
    def build(cls, count: Callable[[str], int], text: str) -> CountTree:
        parts = leaves_of(text)
        return cls(count, *cls._heaps([len(p) for p in parts], [count(p) for p in parts]))

    @staticmethod
    def _heaps(chars: list[int], tokens: list[int]) -> tuple[list[int], list[int]]:
        width = 1 << max(0, (len(chars) - 1).bit_length())
        heaps = []
        for leaves in (chars, tokens):
            heap = [0] * width + leaves + [0] * (width - len(leaves))
            for i in range(width - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            heaps.append(heap)
        return heaps[0], heaps[1]

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and where it starts; the last leaf with
        any characters if ``at`` is the end."""
        at = min(at, self.chars[1] - 1)
        node, start = 1, 0
        while node < self.width:
            left = self.chars[2 * node]
            node *= 2
            if at - start >= left:
                start += left
                node += 1
        return node - self.width, start

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        self.chars[node], self.tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, text: str, start: int, stop: int, new: str) -> str:
        """Replaces ``text[start:stop]``; returns the new text. Ends beyond the text are
        moved into it."""
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        edited = text[:start] + new + text[stop:]
        if not text:
            fresh = CountTree.build(self.count, edited)
            self.chars, self.tokens, self.recoded = fresh.chars, fresh.tokens, self.recoded + len(edited)
            return edited
        # The characters before and after the edit keep their leaves' outer boundaries.
        first, lo = self._find(max(start - 1, 0))
        if start - 1 == lo and lo > 0:
            first, lo = self._find(lo - 1)
        last, at = self._find(stop)
        hi = at + self.chars[last + self.width]
        if stop + 1 >= hi and hi < len(text):
            last, at = self._find(hi)
            hi = at + self.chars[last + self.width]
        region = text[lo:start] + new + text[stop:hi]
        self.recoded += len(region)
        parts = [region] if len(region) <= MOST else leaves_of(region)
        if len(parts) <= last - first + 1:
            for i in range(first, last + 1):
                part = parts[i - first] if i - first < len(parts) else ""
                self._set(i, len(part), self.count(part) if part else 0)
        else:
            width = self.width
            chars, tokens = self.chars[width:], self.tokens[width:]
            chars[first : last + 1] = [len(p) for p in parts]
            tokens[first : last + 1] = [self.count(p) for p in parts]
            kept = [(c, t) for c, t in zip(chars, tokens) if c]
            self.chars, self.tokens = self._heaps([c for c, _ in kept] or [0], [t for _, t in kept] or [0])
        return edited


def _counter(path: str, pattern: str) -> Callable[[str], int]:
    enc = encoding(path, pattern)
    return lambda text: len(encode_text(enc, text))


def _builder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                trees = [CountTree.build(count, t) for t in some.column(1).to_pylist()]
                numbers = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([t.chars for t in trees], numbers), pa.array([t.tokens for t in trees], numbers)],
                    names=["id", "text", "chars", "tokens"],
                )

    return run


def _editor(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                out = []
                for text, chars, tokens, edits in zip(*(c.to_pylist() for c in some.columns[1:])):
                    tree, before = CountTree(count, chars, tokens), tokens[1]
                    for e in edits or ():
                        if e is not None:
                            text = tree.edit(text, e["start"] or 0, e["stop"] or 0, e["text"] or "")
                    out.append((text, tree.chars, tree.tokens, before, tree.total, tree.recoded))
                columns = list(zip(*out)) if out else [[]] * 6
                kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=["id", "text", "chars", "tokens", "n_before", "n_tokens", "recoded"],
                )

    return run


def count_trees(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The state to keep: ``id, text, chars, tokens`` (heaps of sums, the document's count
    at position 1). A null text is an empty one; repeated rows have a tree each."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text"))
    return read.mapInArrow(_builder(path, pattern), "id bigint, text string, chars array<int>, tokens array<int>")


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """The state with the edits ``(id, seq, start, stop, text)`` of each document as one
    array in order of ``seq``; documents without have none. Rows of a null id have none."""
    one = F.struct("seq", "start", "stop", "text")
    lists = edits.groupBy("id").agg(F.sort_array(F.collect_list(one)).alias("found"))
    plain = F.transform("found", lambda e: F.struct(e["start"].cast("bigint").alias("start"), e["stop"].cast("bigint").alias("stop"), e["text"].alias("text")))
    return state.join(lists.select("id", plain.alias("edits")), "id", "left")


def apply_edits(state: DataFrame, path: str, pattern: str) -> DataFrame:
    """The state after its ``edits`` (start and stop in code points of the text as the
    edits before left it; nulls are 0 or nothing, ends beyond the text are moved into
    it), with ``n_before``, ``n_tokens`` and ``recoded``, the characters encoded again."""
    read = state.select("id", "text", "chars", "tokens", F.col("edits").cast(EDITS).alias("edits"))
    schema = "id bigint, text string, chars array<int>, tokens array<int>, n_before bigint, n_tokens bigint, recoded bigint"
    return read.mapInArrow(_editor(path, pattern), schema)
