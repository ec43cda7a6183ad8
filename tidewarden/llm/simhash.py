"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two halves. Two fingerprints at two or fewer differing bits
have a half that differs in one bit at most, so those halves agree once the right bit is
taken out. Every fingerprint posts, for each half, the 32 variants with one bit taken
out; equal variants meet in an equality join and the whole fingerprints are compared.

Halves that more than ``crowded`` different fingerprints share would pair up too often.
For them the other half is cut down too, by one bit (or, where the shared halves are
equal, by two): whoever agrees then differs in two bits at most, so each is linked to the
smallest only, and rows stay in proportion to the fingerprints. Equal fingerprints are
one node throughout.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..sources.shared import new_steps
from ..sources.tables import Steps
from .columns import ROW, row_key
from .components import components

WIDTH = 3
"""Words of a shingle."""
SEED = 42
CROWDED = 128
"""Fingerprints sharing a half, beyond which they are linked by smaller keys."""
HALF = 32
CHUNK = 1 << 16
"""Shingles whose bits are in memory at once."""
_FOLD = bytes(range(256)).lower()


def simhash(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of a text as a signed 64-bit number. Words are between ASCII white
    space, A-Z are lower-cased, shingles count as often as they occur; a shorter text is
    one shingle, and one without words (or null) has fingerprint zero."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[width - 1 :] or ends[-1:]
    shingles = [joined[a:b] for a, b in zip(starts, last)]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(shingles), CHUNK):
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles[i : i + CHUNK]])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def _simhash(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t if isinstance(t, str) else None) for t in texts], dtype="int64")


def as_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _halves(prints: DataFrame) -> DataFrame:
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fp", HALF)
    struct = lambda n, mine, other: F.struct(F.lit(n).cast("bigint").alias("half"), mine.alias("mine"), other.alias("other"))
    return prints.select("fp", F.inline(F.array(struct(0, low, high), struct(1, high, low))))


def _bit(n: str) -> Column:
    return F.expr(f"shiftleft(1L, {n})")


def _variants(halves: DataFrame) -> DataFrame:
    """One row per half and bit taken out; the key names half, bit and what is left."""
    one = halves.select("*", F.explode(F.sequence(F.lit(0), F.lit(HALF - 1))).alias("j"))
    left = F.col("mine").bitwiseAND(F.bitwise_not(_bit("j")))
    return one.withColumn("key", F.expr(f"shiftleft(half * {HALF} + j, {HALF})").bitwiseOR(left))


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 2


def _stars(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Each fingerprint of a key linked to the key's smallest."""
    first = keyed.groupBy(*keys).agg(F.min("fp").alias("a"), F.max("fp").alias("most")).where("a < most")
    return keyed.hint("merge").join(first.drop("most"), keys).where("fp <> a").select("a", F.col("fp").alias("b"))


def links(prints: DataFrame, step: Steps, crowded: int = CROWDED) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that join the same components
    as all pairs at two or fewer differing bits do. No other pair is linked."""
    halves = _halves(prints)
    sizes = halves.groupBy("half", "mine").agg(F.count(F.lit(1)).alias("n"))
    busy = step(sizes.where(F.col("n") > crowded).select("half", "mine"), "busy")
    usual = halves.join(busy, ["half", "mine"], "left_anti")
    # Estimates do not see what an explode makes of a small table: never broadcast it.
    posted = _variants(usual).select("key", "fp").hint("merge")
    met = posted.withColumnRenamed("fp", "a").join(posted.withColumnRenamed("fp", "b"), "key")
    found = met.where((F.col("a") < F.col("b")) & _near("a", "b")).select("a", "b")
    if busy.isEmpty():
        return found

    touched = _variants(busy.withColumns({"fp": F.lit(0), "other": F.lit(0)})).select("key").distinct()
    inside = _variants(halves).join(touched, "key", "left_semi")
    rest = inside.select("key", "fp", "other", F.explode(F.sequence(F.lit(0), F.lit(HALF - 1))).alias("k"))
    by_one = rest.withColumn("rest", F.expr(f"shiftleft(CAST(k AS BIGINT), {HALF}) | (other & ~shiftleft(1L, k))"))
    equal = halves.join(busy, ["half", "mine"], "left_semi")
    pairs = F.expr(f"flatten(transform(sequence(0, {HALF - 2}), k -> transform(sequence(k + 1, {HALF - 1}), l -> struct(k, l))))")
    two = equal.select("*", F.inline(pairs).alias("k", "l"))
    by_two = two.withColumn("rest", F.expr("other & ~(shiftleft(1L, k) | shiftleft(1L, l))"))
    return (
        found.unionAll(_stars(by_one.select("key", "rest", "fp"), ["key", "rest"]))
        .unionAll(_stars(by_two.select("half", "mine", "k", "l", "rest", "fp"), ["half", "mine", "k", "l", "rest"]))
    )


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _named(prints: DataFrame, step: Steps, crowded: int) -> DataFrame:
    """``(fp, root, component_id)`` for every fingerprint of ``prints`` ``(id, fp, ...)``."""
    nodes = step(prints.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), step, crowded), step)
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = step(placed.select("fp", "first", F.coalesce("root", "fp").alias("root")), "placed")
    # Tables of their own, as a join right above an aggregate could not split a large group.
    least = step(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return step(placed.join(least, "root").select("fp", "root", "component_id"), "named")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id that links of two or fewer differing bits reach,
    the row's own included. A null or blank text has fingerprint zero and is linked like
    any other; a row with a null id gets its component but names none (null if it has
    only such rows); repeated rows are returned as often as they come. Other columns of
    the input are not read.
    """
    step = new_steps(docs.sparkSession, "simhash")
    prints = step(_read(docs, id_col, text_col).select("id", _simhash("text").alias("fp")), "prints")
    named = _named(prints, step, crowded).drop("root")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """One row of ``docs`` for each component, as it is: that of the smallest id (a null
    one only where there is no other), of those the smallest hash of the whole row, and
    one of repeated rows. A row is told from others by 128 bits of hash. All columns are passed through. Texts are shuffled only where
    the rows to drop are too many to broadcast, or where rows repeat."""
    step = new_steps(docs.sparkSession, "simhash")
    marked = docs.select("*", *row_key(docs))
    read = marked.select(F.col(f"`{id_col}`").alias("id"), *ROW, F.col(f"`{text_col}`").cast("string").alias("text"))
    prints = step(read.select("id", *ROW, _simhash("text").alias("fp")), "prints")
    rows = prints.join(_named(prints, step, crowded), "fp")
    order = F.struct(F.col("id").isNull().alias("last"), "id", *ROW)
    rows = step(rows.select("id", *ROW, "root"), "rows")
    least = F.min(order)
    firsts = step(rows.groupBy("root").agg(*[least[c].alias(f"{c}_stays") for c in ROW]), "firsts")
    other = reduce(Column.__or__, [F.col(c) != F.col(f"{c}_stays") for c in ROW])
    gone = step(rows.join(firsts, "root").where(other).select(*ROW).distinct(), "gone")
    kept = marked.join(gone, list(ROW), "left_anti")
    if not prints.groupBy(*ROW).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(list(ROW))
    return kept.drop(*ROW)
