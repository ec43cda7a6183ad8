"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the ``k`` smallest distinct shingle hashes of a text.
The sketch of a union is the bottom k of the united sketches, so parts can be sketched
apart and merged, and two sketches estimate resemblance, containment and the number of
distinct shingles; with at most k shingles on both sides the values are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from ..sources.tables import Steps
from .columns import words_of

K = 128
WIDTH = 5
"""Words of a shingle."""
BLOCK = 128
"""Documents of neighbouring ids that are sorted together."""
SPANS = 1024
"""Ranges of ids whose density is looked at; bounds the one table that is broadcast."""


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """``df`` with the sketch of a text column. A text of fewer words than a shingle is
    one shingle; one without words (or null) has an empty sketch. Words are between ASCII
    white space and taken as they are."""
    words, hashes = f"__{name}_words", f"__{name}_hashes"
    df = df.withColumn(words, F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)))
    shingle = ", ".join(f"{words}[i + {j}]" for j in range(width))
    df = df.withColumn(
        hashes,
        F.when(F.size(words) == 0, F.expr("array()").cast("array<bigint>"))
        .when(F.size(words) < width, F.array(F.expr(f"aggregate({words}, 0L, (a, w) -> xxhash64(a, w))")))
        .otherwise(F.expr(f"transform(sequence(0, size({words}) - {width}), i -> xxhash64({shingle}))")),
    ).drop(words)
    return df.withColumn(name, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(hashes)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch for each key from those of its parts, however many. Hashes are made
    distinct and cut to k before and after the shuffle."""
    each = parts.select(key, F.explode(sketch).alias("hash")).distinct()
    first = each.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy("hash"))).where(F.col("n") <= k)
    found = first.groupBy(key).agg(F.sort_array(F.collect_list("hash")).alias(sketch))
    empty = F.coalesce(sketch, F.expr("array()").cast("array<bigint>")).alias(sketch)
    keys = parts.select(F.col(key).alias("__key")).distinct()
    return keys.join(found, keys["__key"].eqNullSafe(found[key]), "left").select(F.col("__key").alias(key), empty)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness; two empty sketches are alike, one empty is not."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union).cast("double"))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    shared = j / (1.0 + j) * (na + nb)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / na))


def as_text(sketch: Column) -> Column:
    """16 hex digits for each hash of a sketch."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _span(size: int) -> Column:
    """Which range an id lies in; decimal, as a range may not fit 64 bits."""
    return F.floor(F.col("id") / F.lit(size).cast("decimal(20,0)")).cast("bigint")


def _in_block(ids: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    met = ids.withColumn("span", _span(size)).join(F.broadcast(spans), "span", "left")
    return met.withColumn("block", F.floor((F.col("id") - F.col("lo")) / F.col("width"))).drop("lo", "width")


def _layout(ids: DataFrame, step: Steps) -> tuple[int, DataFrame, DataFrame]:
    """The size of a range, the ranges with their widths of a block, and for each
    block's first id the block before it (the last block for the first). Widths follow
    the density of ids in each range, so that a block has about ``BLOCK`` documents."""
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    size = 1 if ends["lo"] is None else -(-(ends["hi"] - ends["lo"] + 1) // SPANS)
    spans = ids.groupBy(_span(size).alias("span")).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    width = F.ceil((F.col("hi").cast("double") - F.col("lo") + 1) * BLOCK / F.col("n"))
    spans = step(spans.select("span", "lo", F.greatest(F.lit(1), width).cast("bigint").alias("width")), "spans")

    firsts = _in_block(ids, spans, size).groupBy("span", "block").agg(F.min("id").alias("first"))
    before = F.lag("block").over(W.partitionBy("span").orderBy("block"))
    firsts = step(firsts.withColumn("before", before), "firsts")
    row = W.orderBy("span")  # over at most SPANS + 1 rows
    whole = row.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    last = firsts.groupBy("span").agg(F.max("block").alias("last"))
    turn = last.select(
        "span",
        F.coalesce(F.lag("span").over(row), F.last("span").over(whole)).alias("prev_span"),
        F.coalesce(F.lag("last").over(row), F.last("last").over(whole)).alias("prev_block"),
    )
    inside = F.col("before").isNotNull()
    links = firsts.join(F.broadcast(turn), "span").select(
        F.col("first").alias("id"),
        F.when(inside, F.col("span")).otherwise(F.col("prev_span")).alias("span"),
        F.when(inside, F.col("before")).otherwise(F.col("prev_block")).alias("block"),
    )
    return size, spans, step(links, "links")


def with_next(docs: DataFrame) -> tuple[DataFrame, W]:
    """``(id, text, text_hash)`` beside each document's following one, by one shuffle of
    the texts: documents of neighbouring ids form a block, which also gets the first
    document of the block after it as a ``ghost``. Returns the rows and the window that
    orders them."""
    step = new_steps(docs.sparkSession, "next")
    size, spans, links = _layout(docs.select("id").where(F.col("id").isNotNull()), step)
    loose = -1 - F.pmod("text_hash", F.lit(SPANS))
    placed = _in_block(docs, spans, size).withColumn("block", F.coalesce("block", loose))
    names = ["id", "text", "text_hash", "span", "block"]
    ghosts = docs.join(links, "id").select(*names, F.lit(True).alias("ghost"))
    rows = placed.select(*names, F.lit(False).alias("ghost")).unionAll(ghosts)
    return rows, W.partitionBy("span", "block").orderBy("ghost", "id", "text_hash")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness.

    Edited, the last ``floor(n / 2)`` code points give way to as many (or all) of the
    next document's first ones; next is by ascending id, and the first follows the last.
    Returned: ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``, ``distinct_shingles`` and
    ``kept_in_edited`` (containment). A null text is an empty one. Rows of one id follow
    each other by a hash of their text. Rows with a null id have no place in the order:
    nothing follows them, their edited text only loses its end, and ``near_next`` is
    null. Other columns of the input are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text"))
    rows, order = with_next(read.withColumn("text_hash", F.xxhash64("text")))
    rows = rows.withColumn("following", F.lead("text").over(order))
    rows = rows.withColumn("following", F.when(F.col("id").isNull(), "").otherwise(F.coalesce("following", F.lit(""))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("following"), F.lit(1), half))
    rows = rows.select("*", n.cast("bigint").alias("n_chars"), F.when(F.col("ghost"), "").otherwise(edited).alias("edited"))
    rows = with_sketch(with_sketch(rows, "text", "own", k), "edited", "changed", k)
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "following", "edited")
    rows = rows.withColumn("next", F.lead("own").over(order)).where(~F.col("ghost"))
    own, changed, following = F.col("own"), F.col("changed"), F.col("next")
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        resemblance(own, changed, k).alias("near_edited"),
        F.when(F.col("id").isNotNull(), resemblance(own, following, k)).alias("near_next"),
        distinct_shingles(own, k).alias("distinct_shingles"),
        containment(own, changed, k).alias("kept_in_edited"),
    )
