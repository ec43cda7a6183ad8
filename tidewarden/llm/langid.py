"""Language identification by Bayesian fusion of what a page says and where it is from.

The text gives a likelihood for each language (letter trigrams). The declared markup
language and the address suffix are noisy witnesses: how often each value goes with each
language is counted over all rows. The prior of a row is its host's mix of languages,
smoothed towards its parent domain's, and that towards the whole corpus's, from grouped
counts; the row itself is left out of its host's. All are multiplied and normalised.

The languages are those of all labelled rows with letters. The trigram table is fitted on
a bounded sample of each language's texts; every count, prior and witness table is made
from all rows. Hosts are joined salted, so one that holds a third
of the rows is spread over ``SALT`` keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from .columns import ROW, row_key
BUCKETS = 1 << 14
SAMPLE = 8_000
"""Different labelled texts of each language, about, that the trigram table is fitted on:
those whose hash falls into a share of all hashes that is made for so many."""
LETTER = r"[\p{L}\x{10000}-\x{10FFFF}]"
UNKNOWN = "und"
LEAST = 10
"""Trigrams below which a text says nothing."""
WEIGHT, ENOUGH = 0.3, 200
"""Trigrams depend on each other: each counts as this share, and beyond so many a longer
text says no more."""
STRENGTH = 20.0
"""Rows that a parent's mix counts as in its child's."""
SALT = 32
KEEP = 0.5
OTHER = "other"


@dataclass(frozen=True)
class Model:
    """Log probabilities by language and trigram bucket; the last language is unknown,
    with all buckets alike."""

    languages: tuple[str, ...]
    table: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), dtype=bool, count=1 << 16)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the letter trigrams of a lower-cased text; all that is not a letter is
    one blank, and trigrams around a blank's middle are left out."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    blank = ~_letters()[np.minimum(points, (1 << 16) - 1)] & (points < (1 << 16))
    points = np.concatenate([[0], np.where(blank, 0, points), [0]]).astype(np.uint64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    mixed = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA77) + c * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(0x27D4EB2F) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - 14)).astype(np.int64)[b != 0]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            total += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["lang", "bucket", "n"]
        )


def primary_tag(tag: Column) -> Column:
    """The language part of a tag such as ``de-CH``, lower-cased."""
    return F.lower(F.regexp_extract(F.coalesce(tag, F.lit("")), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))


def fit(labelled: DataFrame, text_col: str, lang_col: str, sample: int = SAMPLE) -> Model:
    """Every language that a text with letters is labelled with is fitted, on ``sample`` or
    so of its different texts. Counts reach the driver: one row per language, and one per
    language and bucket at most."""
    read = labelled.select(primary_tag(F.col(f"`{lang_col}`")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    read = read.where((F.col("lang") != "") & F.col("text").rlike(LETTER)).withColumn("hash", F.xxhash64("text"))
    counts = read.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    below = {r["lang"]: -(2**63) + int(2**64 * (sample / r["n"])) for r in counts if r["n"] > sample}
    if below:
        limits = F.create_map(*[F.lit(x) for pair in sorted(below.items()) for x in pair])
        read = read.where(F.coalesce(F.col("hash") < F.try_element_at(limits, F.col("lang")), F.lit(True)))
    few = read.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    found = few.select("lang", "text").mapInArrow(_counter, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = found.collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    for r in rows:
        table[place[r["lang"]], r["bucket"]] += r["n"]
    table[-1] = 1.0
    return Model((*languages, UNKNOWN), np.log(table / table.sum(axis=1, keepdims=True)))


def text_evidence(model: Model, text: str | None) -> list[float]:
    """Log likelihoods of a text, weighted; all zero where it says nothing."""
    at = trigrams(text) if text else np.zeros(0, dtype=np.int64)
    if len(at) < LEAST:
        return [0.0] * len(model.languages)
    return (model.table[:, at].sum(axis=1) * (WEIGHT * min(len(at), ENOUGH) / len(at))).tolist()


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` has ``text``, ``declared``, ``suffix`` and ``host`` (strings) beside any
    others, which are passed through without the text: added are ``lang``, ``posterior``
    and ``text_lang``.

    Nulls: a missing text, declaration, suffix or host is no evidence. A text without
    letters says nothing and goes by the rest. ``und`` is a text unlike any language
    fitted. Ties go to the language first in order. An empty input gives an empty table.
    """
    spark, n = rows.sparkSession, len(model.languages)
    step = new_steps(spark, "langid")
    passed = [c for c in rows.columns if c not in ("text", "declared", "suffix", "host", "lang", "posterior", "text_lang")]

    @F.arrow_udf("array<double>")
    def evidence(texts: pa.Array) -> pa.Array:
        return pa.array([text_evidence(model, t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    known = list(model.languages[:-1])
    declared = primary_tag(F.col("declared"))
    declared = F.when(declared == "", None).when(declared.isin(known), declared).otherwise(OTHER)
    suffix = F.lower("suffix")
    host = F.lower(F.coalesce("host", F.lit("")))
    seen = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in passed], F.lit(0).alias("__any")).alias("row"),
        declared.alias("declared"),
        F.when(suffix.rlike("^[a-z]{2}$"), suffix).when(F.length(suffix) > 0, OTHER).alias("suffix"),
        host.alias("host"),
        F.when(F.instr(host, ".") > 0, F.regexp_replace(host, r"^[^.]*\.", "")).otherwise("").alias("parent"),
        evidence(F.col("text").cast("string")).alias("log_text"),
    )
    # Rows written here carry no texts.
    seen = step(seen, "seen")
    said = F.exists("log_text", lambda x: x != 0)
    best = F.array_position("log_text", F.array_max("log_text")).cast("int") - 1
    seen = seen.withColumn("first", F.when(said, best))
    counts = F.array(*[F.count_if(F.col("first") == i) for i in range(n)]).alias("counts")

    overall = seen.agg(counts).first()["counts"]
    total = sum(overall)
    share = [(c + 1.0) / (total + n) for c in overall]
    witnesses = {c: seen.where(F.col(c).isNotNull()).groupBy(c).agg(counts).collect() for c in ("declared", "suffix")}

    by_host = step(seen.groupBy("host", "parent").agg(counts), "hosts")
    parents = by_host.groupBy("parent").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(n)]).alias("above"))
    above_total = F.aggregate("above", F.lit(0).cast("bigint"), lambda a, x: a + x)
    smoothed = F.array(*[(F.col("above")[i] + STRENGTH * share[i]) / (above_total + STRENGTH) for i in range(n)])
    parents = parents.select("parent", F.when(F.col("parent") != "", smoothed).otherwise(F.array(*map(F.lit, share))).alias("above"))
    hosts = by_host.join(parents, "parent").select("host", "counts", "above")
    hosts = step(hosts, "priors").select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))

    salted = seen.withColumn("salt", F.pmod(F.xxhash64("row", "host", "log_text"), F.lit(SALT)).cast("int"))
    met = salted.join(hosts.hint("merge"), ["host", "salt"])
    mine = lambda i: F.when(F.col("first") == i, 1).otherwise(0)
    others = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x) - F.when(F.col("first").isNotNull(), 1).otherwise(0)

    def witness(column: str, i: int) -> Column:
        """How often the language goes with the value, smoothed by one row."""
        table = {r[column]: r["counts"] for r in witnesses[column]}
        of = sum(c[i] for c in table.values())
        logs = {v: float(np.log((c[i] + 1.0) / (of + len(table) + 1.0))) for v, c in table.items()}
        if not logs:
            return F.lit(0.0)
        lookup = F.create_map(*[F.lit(x) for pair in sorted(logs.items()) for x in pair])
        return F.coalesce(F.when(F.col(column).isNotNull(), F.try_element_at(lookup, F.col(column))), F.lit(0.0))

    def score(i: int) -> Column:
        prior = (F.col("counts")[i] - mine(i) + STRENGTH * F.col("above")[i]) / (others + STRENGTH)
        return F.col("log_text")[i] + F.log(prior) + witness("declared", i) + witness("suffix", i)

    met = met.withColumn("scores", F.array(*[score(i) for i in range(n)]))
    met = met.withColumn("top", F.array_max("scores"))
    weights = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(x) for x in model.languages])
    return met.select(
        *[F.col("row").getField(c).alias(c) for c in passed],
        names[F.array_position("scores", F.col("top")).cast("int") - 1].alias("lang"),
        (1.0 / weights).alias("posterior"),
        F.when(F.col("first").isNotNull(), names[F.col("first")]).alias("text_lang"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """``page_id`` and the evidence of raw web pages: text outside the markup, the html
    tag's language, the host, and the suffix of the address (a language or country as
    the path's first part, or else the host's last)."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    outside = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w{1,10};"
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1)
    top = F.regexp_extract(host, r"\.([^.]+)$", 1)
    return pages.select(
        "page_id",
        F.regexp_replace(html, outside, " ").alias("text"),
        F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z_-]+)", 1), F.lit("")).alias("declared"),
        F.nullif(F.when(path != "", path).otherwise(top), F.lit("")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
    )


def accepted(found: DataFrame, keep: float = KEEP) -> Column:
    """A language was found, with a posterior of at least ``keep``."""
    return (found["lang"] != UNKNOWN) & (found["posterior"] >= keep)


def keep_known(
    docs: DataFrame,
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
    sample: int = SAMPLE,
    keep: float = KEEP,
) -> DataFrame:
    """The rows of ``docs`` whose language is known, as they are. Rows that agree in all
    columns are decided alike. An empty table stays so. Texts are not shuffled while the
    rows to leave out are few enough for Spark to broadcast them."""
    marked = docs.select("*", *row_key(docs))
    model = fit(docs, text_col, declared_col, sample)
    read = marked.select(
        *ROW,
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{declared_col}`").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col(f"`{host_col}`").alias("host"),
    )
    step = new_steps(docs.sparkSession, "langid-kept")
    found = step(identify(read, model), "found")
    rejected = step(found.where(~accepted(found, keep)).select(*ROW).distinct(), "rejected")
    return marked.join(rejected, list(ROW), "left_anti").drop(*ROW)
