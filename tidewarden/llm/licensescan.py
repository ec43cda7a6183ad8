"""License scans: MinHash bands over text windows retrieve notices, containment decides.

A notice is present where some window of a text holds at least ``CONTAINED`` of its
distinct word shingles. Notices are put into classes of like length, and a class's
windows are a little longer than its notices and overlap by all but a step, so what a
match can have as Jaccard likeness with its window is bounded below. The number of bands
follows from that bound: a match shares a band with a chance of at least 1 - ``MISS``.
Windows that share no shingle with any notice of the class have likeness zero and are not
hashed. The shingles of a window retrieved are then compared with the notice's, as text.

Notices are a parameter of bounded size, so what is joined to windows is broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licenses import TEMPLATES

WIDTH = 5
"""Words of a shingle."""
CONTAINED = 0.8
ROWS = 2
"""Hashes of a band."""
MISS = 1e-6
STEP_SHARE = 4
"""A window moves on by one part in this many of its class's longest notice."""
RATIO = 1.25
"""Lengths of a class differ by no more than this factor."""
MOST_NOTICES = 10_000
_WORD = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Notice:
    number: int
    license: str
    shingles: tuple[str, ...]


@dataclass(frozen=True)
class Class:
    """Notices of like length, the windows they are looked for in, and the bands."""

    number: int
    notices: tuple[Notice, ...]
    step: int
    size: int
    bands: int


def shingles_of(text: str, width: int = WIDTH) -> tuple[str, ...]:
    """The distinct shingles of a notice, in order; a shorter one is one shingle."""
    # Letters and digits of any script, as the pattern for Spark has them.
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    if not words:
        return ()
    return tuple(dict.fromkeys(" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))))


def classes_of(templates: Sequence[tuple[str, str]], rows: int = ROWS, miss: float = MISS) -> list[Class]:
    """Classes by length. Of ``n`` shingles a match has ``m = ceil(CONTAINED * n)`` in a
    window of ``size``, so their likeness is ``m / (size + n - m)`` at least, and
    ``bands`` bands of ``rows`` hashes all miss it with a chance of ``miss`` at most.
    Notices shorter than a shingle are not looked for."""
    if len(templates) > MOST_NOTICES:
        raise ValueError(f"more than {MOST_NOTICES} notices")
    notices = [Notice(i, name, shingles_of(text)) for i, (name, text) in enumerate(templates)]
    notices = sorted((n for n in notices if n.shingles and n.shingles[0].count(" ") == WIDTH - 1), key=lambda n: len(n.shingles))
    out: list[Class] = []
    while notices:
        longest = max(len(notices[0].shingles), int(len(notices[0].shingles) * RATIO))
        mine = tuple(n for n in notices if len(n.shingles) <= longest)
        notices = notices[len(mine) :]
        longest = len(mine[-1].shingles)
        step = max(1, longest // STEP_SHARE)
        size = longest + step
        least = 1.0
        for n in mine:
            m = math.ceil(CONTAINED * len(n.shingles) - 1e-9)
            least = min(least, m / (size + len(n.shingles) - m))
        share = least**rows
        bands = 1 if share >= 1 else math.ceil(math.log(miss) / math.log(1 - share))
        out.append(Class(len(out), mine, step, size, bands))
    return out


def _shingle_hash(text: Column) -> Column:
    return F.xxhash64(text)


def _band_keys(hashes: Column, bands: int, rows: int = ROWS) -> Column:
    """One key for each band: the least of the shingles' hashes under its functions."""

    def least(band: Column, row: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band * rows + row)))

    every = F.sequence(F.lit(0), F.lit(bands - 1))
    return F.transform(every, lambda b: F.xxhash64(b, *[least(b, r) for r in range(rows)]))


def _positions(values: Column, holds: Callable[[Column], Column]) -> Column:
    """Where in an array a condition holds, from 0."""
    return F.array_compact(F.transform(values, lambda v, i: F.when(holds(v), i)))


def _windows(hashes: Column, c: Class, known: list[int]) -> Column:
    """The class's windows that hold one of its shingles: class, start and size."""

    def over(spot: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((spot - c.size + 1) / F.lit(c.step)).cast("int"))
        return F.sequence(first, F.floor(spot / F.lit(c.step)).cast("int"))

    starts = F.array_distinct(F.flatten(F.transform(_positions(hashes, lambda h: h.isin(known)), over)))
    return F.transform(
        starts,
        lambda w: F.struct(F.lit(c.number).alias("class"), (w * c.step).alias("start"), F.lit(c.size).alias("size")),
    )


def _notices(spark: SparkSession, classes: list[Class]) -> DataFrame:
    """``(class, notice, license, parts, key)``: one row per notice and band key."""
    rows = [
        F.struct(
            F.lit(c.number).alias("class"),
            F.lit(n.number).alias("notice"),
            F.lit(n.license).alias("license"),
            F.array(*[F.lit(s) for s in n.shingles]).alias("parts"),
            F.lit(c.bands).alias("bands"),
        )
        for c in classes
        for n in c.notices
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    hashes = F.transform("parts", _shingle_hash)
    keys = F.coalesce(*[F.when(F.col("bands") == b, _band_keys(F.col("hashes"), b)) for b in sorted({c.bands for c in classes})])
    table = table.withColumn("hashes", hashes)
    return table.select("class", "notice", "license", "parts", F.explode_outer(F.array_distinct(keys)).alias("key"))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    contained: float = CONTAINED,
) -> DataFrame:
    """``id_col, license, notice, containment, first_word, last_word`` for every notice
    that a text holds, at its best window (the earliest of the best); ``notice`` is its
    number in ``templates``, and words count from 0.

    Words are runs of letters and digits, lower-cased. Null, empty and shorter texts hold
    none; repeated rows of one id and text are one; a null id is carried along. Other
    columns of the input are not read.
    """
    spark = docs.sparkSession
    classes = classes_of(templates)
    schema = "id {t}, license string, notice int, containment double, first_word int, last_word int"
    if not classes:
        kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
        return spark.createDataFrame([], schema.format(t=kind)).withColumnRenamed("id", id_col)
    notices = _notices(spark, classes)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    read = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    read = read.withColumn("words", F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))).drop("text")
    five = ", ' ', ".join(f"words[i + {j}]" for j in range(WIDTH))
    at = f"if(size(words) < {WIDTH}, array(), sequence(0, size(words) - {WIDTH}))"
    read = read.withColumn("hashes", F.expr(f"transform({at}, i -> xxhash64(concat({five})))"))

    # Which hashes are a notice's is known before the texts are read.
    ours = spark.range(1).select(
        *[
            F.transform(F.array(*[F.lit(s) for n in c.notices for s in n.shingles]), _shingle_hash).alias(f"c{c.number}")
            for c in classes
        ]
    ).first()
    known = {c.number: sorted(set(ours[f"c{c.number}"])) for c in classes}
    all_known = sorted({h for hs in known.values() for h in hs})
    any_hit = F.exists("hashes", lambda h: h.isin(all_known))
    per_class = [_windows(F.col("hashes"), c, known[c.number]) for c in classes]
    # The outer forms keep the optimiser from testing the arrays below, where it would
    # make them once more for every element.
    windows = read.select("id", "text_hash", "words", F.inline_outer(F.when(any_hit, F.concat(*per_class))))
    windows = windows.where(F.col("class").isNotNull())
    windows = windows.withColumn("words", F.slice("words", F.col("start") + 1, F.col("size") + WIDTH - 1))
    windows = windows.withColumn("parts", F.expr(f"transform({at}, i -> concat({five}))")).drop("words", "size")
    windows = windows.withColumn("hashes", F.transform("parts", _shingle_hash))
    keys = F.coalesce(
        *[F.when(F.col("class") == c.number, _band_keys(F.col("hashes"), c.bands)) for c in classes]
    )
    keyed = windows.select("id", "text_hash", "class", "start", F.col("parts").alias("inside"), F.explode_outer(keys).alias("key"))
    met = keyed.join(F.broadcast(notices), ["class", "key"])
    shared = F.size(F.array_intersect("parts", "inside")) / F.size("parts")
    met = met.withColumn("containment", shared).where(F.col("containment") >= contained - 1e-9)
    inside = _positions(F.col("inside"), lambda s: F.array_contains(F.col("parts"), s))
    best = met.groupBy("id", "text_hash", "license", "notice").agg(
        F.min(
            F.struct(
                (-F.col("containment")).alias("less"),
                "start",
                (F.col("start") + F.array_min(inside)).alias("first_word"),
                (F.col("start") + F.array_max(inside) + WIDTH - 1).alias("last_word"),
            )
        ).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        "license",
        "notice",
        (-F.col("best.less")).alias("containment"),
        F.col("best.first_word").cast("int").alias("first_word"),
        F.col("best.last_word").cast("int").alias("last_word"),
    )
