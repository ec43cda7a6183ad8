"""Byte-level BPE by the tiktoken library and a local rank file.

Long texts are split before tiktoken sees them, at places that its pattern never crosses:
before white space that follows something else, and before the last character of a run
of white space that something follows. So neither the length of a text nor that of a run
of white space is ever matched at once.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

LONG = 1 << 16
"""Characters beyond which a text is split."""
AT_ONCE = 1 << 20
"""Characters whose tokens a worker holds at once, or one text."""
RUN = 256
"""White space beyond which a run is split off."""
# The characters that the pattern's \s stands for.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(rf"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_LONG_RUN = re.compile(rf"[{_WHITE}]{{{RUN},}}")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per worker process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, long: int = LONG) -> list[str]:
    """The text in parts whose tokens are the text's own."""
    cuts = {0, len(text)}
    for run in _LONG_RUN.finditer(text):
        cuts.add(run.start())
        if run.end() < len(text):
            cuts.add(run.end() - 1)
    at = 0
    while len(text) - at > long and (cut := _CUT.search(text, at + long)):
        at = cut.start()
        cuts.add(at)
    return [text[a:b] for a, b in pairwise(sorted(cuts))]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text):
        # A run of white space is one pre-token, and too long for the pattern's look-ahead.
        one = len(part) >= RUN - 1 and _LONG_RUN.fullmatch(part + part[-1])
        ids += enc._encode_single_piece(part) if one else enc.encode_ordinary(part)
    return ids


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``AT_ONCE`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= AT_ONCE or i + 1 - start >= 1000:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _encoder(path: str, pattern: str) -> Work:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _slices(texts):
                found = [np.array(encode_text(enc, t or ""), dtype=np.int32) for t in texts[a:b]]
                ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["id", "ids"])

    return run


def _decoder(path: str, pattern: str) -> Work:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            ids = batch.column(1)
            for a in range(0, len(ids), 1000):
                some = ids.slice(a, 1000)
                text = [None if x is None else enc.decode_bytes(x) for x in (s.as_py() for s in some)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, 1000), some, pa.array(text, pa.binary())], names=["id", "ids", "decoded"]
                )

    return run


def _kind(df: DataFrame, column: str) -> str:
    return df.select(F.col(f"`{column}`")).schema[0].dataType.simpleString()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)``: the token ids of every text, a null one as an empty one, without
    special tokens. Other columns of the input are not read."""
    schema = f"id {_kind(docs, id_col)}, ids array<int>"
    found = _texts(docs, id_col, text_col).mapInArrow(_encoder(path, pattern), schema)
    return found.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, ids_col, decoded)``: the bytes that token ids stand for, which need not
    be valid UTF-8; null for null."""
    read = tokens.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    schema = f"id {_kind(tokens, id_col)}, ids array<int>, decoded binary"
    found = read.mapInArrow(_decoder(path, pattern), schema)
    return found.withColumnsRenamed({"id": id_col, "ids": ids_col})


def token_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` for every row, encoded and decoded
    in one pass of the workers; nulls as empty texts. Other columns are not read."""
    to, fro = _encoder(path, pattern), _decoder(path, pattern)

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fro(to(batches))

    schema = f"id {_kind(docs, id_col)}, ids array<int>, decoded binary"
    both = _texts(docs, id_col, text_col).mapInArrow(there_and_back, schema)
    return both.select(
        F.col("id").alias(id_col),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
