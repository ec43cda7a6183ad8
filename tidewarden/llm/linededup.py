"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes, bucketed and sorted by hash, with the number of documents
that hold each and the largest id among them. Every batch of documents is merge-anti-joined
with the runs: hashes that no run holds are new, the others only add to what is known, and
both go into the batch's own run at level 0, marked apart. As soon as a level holds
``fanout`` runs they are merged into one of the next level, so a hash is rewritten once per
level and a batch meets few runs. A batch is shuffled by hash once, for its own counts; the
runs it meets have the same buckets and are not shuffled.

Documents are never gathered: hashes travel, and texts meet the positions to drop in one
join. A line that a third of all documents hold is one row of a run, made by a partial
aggregate, and meets its occurrences in a plain join that is broadcast or split.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_steps
from .columns import lower_ascii, with_outputs

MIN_DOCS, MIN_CHARS = 5, 40
FANOUT = 4
BATCHES = 4
BLANK = " \t\n\x0b\f\r"
RUN = "hash bigint, n bigint, last bigint, known boolean"


def line_hash(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """64-bit hash of a line's key; null if the key is too short to count. Two keys that
    share a hash would be taken for one line (one chance in 2**64 for a pair)."""
    bare = F.trim(line, F.lit(BLANK))
    # Lower-casing keeps the length, so short lines are not copied for it.
    return F.when(F.length(bare) >= min_chars, F.xxhash64(lower_ascii(bare)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, row_hash, hashes)``: the hash of every line of every document, in order."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.xxhash64(text).alias("row_hash"),
        F.transform(split_lines(text), lambda x: line_hash(x, min_chars)).alias("hashes"),
    )


class Run(NamedTuple):
    bucketed: DataFrame
    path: str


class LineRuns:
    """Levelled runs in a shared folder: ``hash``, sorted, ``n`` and ``last`` of a batch or
    of several, and ``known``, true where an older run holds the hash already."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, max(2, fanout)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.step = new_steps(spark, "lineruns")
        self.levels: list[list[Run]] = []
        self._written = 0

    def _write(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self._written += 1
        # Spark keeps buckets with a table's name only; the run as read holds them itself,
        # so the name can go at once. The files stay.
        name = f"line_run_{uuid.uuid4().hex}"
        path = self.step.path(f"level-{level}-run-{self._written}")
        writer = run.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
        writer.option("path", path).saveAsTable(name)
        self.levels[level].append(Run(self.spark.table(name), path))
        self.spark.sql(f"DROP TABLE {name}")

    def _merge(self, runs: list[Run]) -> DataFrame:
        """One row per hash. Runs are read here without their buckets: Spark takes a union of
        bucketed scans for bucketed, but lays their column batches end to end, so that equal
        hashes would stay apart."""
        plain = [self.spark.read.schema(RUN).parquet(run.path) for run in runs]
        both = reduce(DataFrame.unionAll, plain).groupBy("hash")
        return both.agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.bool_and("known").alias("known"))

    def runs(self) -> list[Run]:
        """All runs, oldest first."""
        return [run for level in reversed(self.levels) for run in level]

    def add(self, lines: DataFrame) -> None:
        """Adds the run of a batch of ``hashed_lines`` and compacts full levels."""
        each = lines.select("id", F.explode(F.array_distinct(F.array_compact("hashes"))).alias("hash"))
        batch = each.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        self._write(self.told(batch), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merge(full), level + 1)
            level += 1

    def told(self, batch: DataFrame) -> DataFrame:
        """A batch ``(hash, ...)`` with ``known``: whether a run holds the hash. Every hash
        is new in exactly one run, so a batch meets the new ones of each run only. The rows
        that are not known are the anti-join; the others come out of the same merge."""
        columns, known = batch.columns, F.lit(False)
        for n, run in enumerate(self.runs()):
            flag = f"in_{n}"
            batch = batch.join(run.bucketed.where(~F.col("known")).select("hash", F.lit(True).alias(flag)), "hash", "left")
            known = known | F.col(flag).isNotNull()
        return batch.select(*columns, known.alias("known"))

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows ``(id, row_hash, pos, hash)`` of a batch whose line no run holds."""
        return self.told(positions(lines)).where(~F.col("known")).select("id", "row_hash", "pos", "hash")

    def common(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """``(hash, last)`` of the lines that at least ``min_docs`` documents hold."""
        if not self.runs():
            return self.spark.createDataFrame([], RUN).select("hash", "last")
        return self._merge(self.runs()).where(F.col("n") >= min_docs).select("hash", "last")


def positions(lines: DataFrame) -> DataFrame:
    """One row per line with a hash."""
    each = lines.select("id", "row_hash", F.posexplode("hashes").alias("pos", "hash"))
    return each.where(F.col("hash").isNotNull())


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with their text less the dropped lines, and ``n_lines``, ``n_dropped``.

    A line whose key (stripped of white space, A-Z lower-cased) has ``min_chars`` code
    points and is held by ``min_docs`` documents is dropped everywhere but in the largest
    id that holds it; there all its repetitions stay. A null or empty text is one empty
    line, and is returned as an empty text. Each row counts as a document, repeated rows
    too. Rows with a null id count, but come after none: they lose such a line if any row
    with an id holds it, and keep it otherwise. All other columns are passed through; an
    input column named like an output is replaced. The documents are taken in ``batches``
    by a hash of their text; their number changes nothing in the result.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, fanout)
    batch = F.pmod("row_hash", F.lit(max(1, batches))).cast("int")
    lines = runs.step(
        hashed_lines(docs, id_col, text_col, min_chars).withColumn("batch", batch), "lines", ("batch",)
    )
    for n in range(max(1, batches)):
        runs.add(lines.where(F.col("batch") == n))
    common = runs.step(runs.common(min_docs), "common")
    dropped = (
        positions(lines)
        .join(common, "hash")
        .where((F.col("id") < F.col("last")) | (F.col("id").isNull() & F.col("last").isNotNull()))
        .groupBy("id", "row_hash")
        .agg(F.collect_set("pos").alias("drop"))
    )
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row").getField(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("row_hash"))
    same = rows["id"].eqNullSafe(dropped["id"]) & (rows["row_hash"] == dropped["row_hash"])
    met = rows.join(dropped, same, "left").select("row", "drop")
    n = F.size(split_lines(text))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    lines_kept = F.expr("transform(at, i -> all[i])")
    rest = met.withColumns({"all": split_lines(text), "at": kept}).withColumn("kept", F.array_join(lines_kept, "\n"))
    rest = rest.withColumn("out", F.when(F.col("drop").isNull(), text).otherwise(F.col("kept")))
    return with_outputs(
        rest,
        docs.columns,
        **{
            text_col: F.col("out"),
            "n_lines": n.cast("bigint"),
            "n_dropped": F.coalesce(F.size("drop"), F.lit(0)).cast("bigint"),
        },
    )
