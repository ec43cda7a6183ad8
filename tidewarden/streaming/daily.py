"""Daily series of orders, items and payments that arrive as streams.

Each micro-batch is added up by order and joined with a table of what is known so far, one
row per order: its headers, the sum of its items and the number of its payments, which is
all that daily totals need. Whatever comes for an order, in whatever sequence, gives a signed
change: what the order adds to its days now, less what it added before. The changes go to the
store of ``incremental``. All is DataFrame functions, no Python per order. The table of a
batch is made from that of the batch before, which stays, so a batch that is run again gives
the same table and adds nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..operators.facts import RawTables, check_fanout, order_headers, order_payments, priced_items
from ..operators.incremental import STORED, update_rollup, write_rollup
from ..operators.rollup import TOTAL, series_column
from ..sources.shared import new_steps

HEADER, ITEM, PAYMENT = "header", "item", "payment"
DAY = 86_400_000
_HEADERS = "array<struct<series_id: string, ds: date, status: string, n: bigint, old: bigint>>"
_KNOWN = (
    f"headers {_HEADERS}, amount double, items bigint, payments bigint, until bigint, "
    "old_amount double, old_items bigint, old_payments bigint, touched boolean, gone boolean, "
    "batch bigint, used bigint, watermark bigint"
)
"""A row per order; ``n`` and the plain sums hold after the batch, ``old`` before it. Orders
that are ``gone`` are given up with this batch. One row without an order has its number, the
watermark it ``used`` and the one it leaves."""


def order_events(raw: RawTables, series_col: str | None = None, fanout: str = "faithful") -> DataFrame:
    """All rows of ``raw.orders``, ``raw.items`` and ``raw.payments``, which are streams, in
    one shape. Customers and products are tables. Rows without an order, and orders of
    unknown customers, drop out, as in the mart."""
    check_fanout(fanout)
    at = F.col("purchase_ts").cast("timestamp")
    no = {"series_id": "string", "ds": "date", "status": "string", "at_ms": "bigint"}
    nothing = [F.lit(None).cast(t).alias(c) for c, t in no.items()]
    one = F.lit(1).cast("bigint").alias("n")
    headers = order_headers(raw).select(
        "order_id", F.lit(HEADER).alias("kind"), series_column(series_col), F.col("purchase_date").alias("ds"),
        F.col("order_status").cast("string").alias("status"), F.unix_millis(at).alias("at_ms"), F.lit(0.0).alias("amount"), one,
    )
    amount = F.coalesce((F.col("price") + F.col("freight_value")).cast("double"), F.lit(0.0))
    items = priced_items(raw).select("order_id", F.lit(ITEM).alias("kind"), *nothing, F.nanvl(amount, F.lit(0.0)).alias("amount"), one)
    rows = headers.unionByName(items)
    if fanout == "faithful":
        paid = order_payments(raw, fanout).select("order_id", F.lit(PAYMENT).alias("kind"), *nothing, F.lit(0.0).alias("amount"), one)
        rows = rows.unionByName(paid)
    return rows.where(F.col("order_id").isNotNull())


def _added_up(events: DataFrame) -> DataFrame:
    """Equal rows of a batch as one; combined before they are shuffled, so that an order
    with very many arrives as few."""
    sums = [F.max("at_ms").alias("at_ms"), F.sum("amount").alias("amount"), F.sum("n").alias("n")]
    return events.groupBy("order_id", "kind", "series_id", "ds", "status").agg(*sums)


def _is_late(watermark: int) -> Column:
    return (F.col("kind") == HEADER) & F.coalesce(F.col("at_ms") < watermark, F.lit(False))


def _merged(headers: Column) -> Column:
    """Headers of like series, day and status as one."""

    def key(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("series_id", "ds", "status")])

    def total(k: Column, count: str) -> Column:
        own = F.filter(headers, lambda x: key(x).eqNullSafe(k))
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: s + x[count])

    keys = F.array_distinct(F.transform(headers, key))
    return F.transform(keys, lambda k: F.struct(*[k[c].alias(c) for c in ("series_id", "ds", "status")], *[total(k, c).alias(c) for c in ("n", "old")]))


def _next(known: DataFrame, rows: DataFrame, watermark: int, keep_days: int) -> DataFrame:
    """``known``, after the batch ``rows``."""
    keep, zero = keep_days * DAY, F.lit(0).cast("bigint")

    def of(kind: str, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(value))), F.lit(0))

    header = F.struct("series_id", "ds", "status", "n", zero.alias("old"))
    new = rows.where(~_is_late(watermark)).groupBy(F.col("order_id").alias("new_id")).agg(
        F.collect_list(F.when(F.col("kind") == HEADER, header)).alias("new_headers"),
        F.max(F.when(F.col("kind") == HEADER, F.greatest(F.coalesce("at_ms", zero), F.lit(watermark)))).alias("newest"),
        of(ITEM, "amount").cast("double").alias("new_amount"), of(ITEM, "n").alias("new_items"), of(PAYMENT, "n").alias("new_payments"),
    )
    both = known.join(new, known["order_id"] == new["new_id"], "full")
    none = F.array().cast(_HEADERS)
    before = F.transform(F.coalesce("headers", none), lambda h: h.withField("old", h["n"]))
    added = F.coalesce("new_headers", none)
    either = (F.size(before) == 0) | (F.size(added) == 0)
    touched = F.col("new_id").isNotNull()
    until = F.coalesce("until", zero)
    # What came before there was a watermark to wait from waits from the first.
    waits = F.when(F.col("newest").isNotNull(), F.greatest(until, F.col("newest") + keep)).when(
        (until == 0) & (F.lit(watermark) > 0), F.lit(watermark + keep)
    ).otherwise(until)
    past = ~touched & (until > 0) & (until < watermark)
    old = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("amount", "items", "payments")}
    return both.select(
        F.coalesce("order_id", "new_id").alias("order_id"),
        F.when(either, F.concat(before, added)).otherwise(_merged(F.concat(before, added))).alias("headers"),
        *[(old[c] + F.coalesce(F.col(f"new_{c}"), F.lit(0))).alias(c) for c in old],
        F.when(touched & (waits > 0), F.greatest(waits, F.lit(watermark + 1))).otherwise(waits).alias("until"),
        *[value.alias(f"old_{c}") for c, value in old.items()],
        touched.alias("touched"),
        past.alias("gone"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("batch", "used", "watermark")],
    )


def _adds(n: str, prefix: str) -> list[Column]:
    """What a header adds to its day of a series: nothing while its order has no items;
    these count once per payment, or once."""
    there = (F.col(f"{prefix}items") > 0) & (F.col(f"h.{n}") > 0)
    delivered = there & F.coalesce(F.col("h.status") == "delivered", F.lit(False))
    revenue = F.col(f"h.{n}") * F.col(f"{prefix}amount") * F.greatest(F.col(f"{prefix}payments"), F.lit(1))
    failed = there & F.coalesce(F.col("h.status") != "delivered", F.lit(False))
    counts = {"orders": delivered, "failed": failed, "total": there}
    return [F.when(delivered, revenue).otherwise(0.0).alias(f"{prefix}revenue"), *[c.cast("bigint").alias(f"{prefix}{k}") for k, c in counts.items()]]


def _changes(known: DataFrame) -> DataFrame:
    """What a batch adds to each day of a series: orders as they are less as they were."""
    rows = known.where("touched").withColumn("h", F.explode("headers"))
    rows = rows.withColumnsRenamed({c: f"new_{c}" for c in ("amount", "items", "payments")})
    rows = rows.select("order_id", "h.series_id", "h.ds", *_adds("n", "new_"), *_adds("old", "old_"))
    each = rows.groupBy("order_id", "series_id", "ds").agg(
        *[F.sum(f"{w}_revenue").alias(f"{w}_revenue") for w in ("new", "old")],
        *[F.max(f"{w}_{c}").alias(f"{w}_{c}") for w in ("new", "old") for c in ("orders", "failed", "total")],
    )
    moved, sums = F.lit(False), []
    for c in ("revenue", "orders", "failed", "total"):
        moved = moved | (F.col(f"new_{c}") != F.col(f"old_{c}"))
        sums.append(F.sum(F.col(f"new_{c}") - F.col(f"old_{c}")).alias(c))
    return each.where(moved).groupBy("series_id", "ds").agg(*sums)


def _waited_in_vain(known: DataFrame) -> DataFrame:
    """Items and payments given up without their order."""
    lone = known.where(F.col("gone") & (F.size("headers") == 0))
    kinds = F.array(*[F.struct(F.lit(k).alias("late"), F.col(c).alias("n")) for k, c in ((ITEM, "items"), (PAYMENT, "payments"))])
    each = lone.select(F.explode(kinds).alias("x")).groupBy("x.late").agg(F.sum("x.n").alias("n")).where(F.col("n") > 0)
    return each.select(F.lit(None).cast("string").alias("series_id"), F.lit(None).cast("date").alias("ds"), "late", "n")


@dataclass(frozen=True)
class DailyStream:
    """Where a stream of daily totals keeps its tables."""

    folder: str
    unit: str = "month"

    @property
    def rollup(self) -> str:
        """The store: ``read_rollup`` reads it, ``kpi_daily_from_rollup`` gives the series."""
        return f"{self.folder}/rollup"

    @property
    def late(self) -> str:
        """``(series_id, ds, late, n, batch)``: rows that came too late, by kind. What was given
    up when a run ended after batch ``n`` has the number ``-1 - n``."""
        return f"{self.folder}/late"

    @property
    def known(self) -> str:
        """What is known of each order: tables of the last two batches, in turn, and one of
        the last run's end."""
        return f"{self.folder}/known"

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"


class _Known:
    """The tables of ``DailyStream.known``."""

    def __init__(self, spark: SparkSession, to: DailyStream, key: StructField) -> None:
        self.spark, self.to = spark, to
        self.shape = StructType([key, *_parse_datatype_string(_KNOWN).fields])

    def path(self, name: int | str) -> str:
        return f"{self.to.known}/{name}"

    def read(self, name: int | str) -> DataFrame:
        return self.spark.read.schema(self.shape).parquet(self.path(name))

    def write(self, rows: DataFrame, name: int | str, batch: int, used: int, watermark: int) -> None:
        told = {"batch": batch, "used": used, "watermark": watermark}
        end = self.spark.createDataFrame([tuple(told.get(c) for c in self.shape.names)], self.shape)
        rows.select(*self.shape.names).unionByName(end).write.mode("overwrite").parquet(self.path(name))

    def end(self, name: int | str) -> Row | None:
        """The row without an order; none where no such table was ever written whole."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path(name))
        if not at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
            return None
        return self.read(name).where(F.col("order_id").isNull()).select("batch", "used", "watermark").first()

    def after(self, batch: int) -> tuple[DataFrame, int]:
        """What was known after a batch, and the watermark."""
        for name in ("end", batch % 2):
            end = self.end(name) if batch >= 0 else None
            if end is not None and end["batch"] == batch:
                return self.read(name).where(F.col("order_id").isNotNull() & ~F.col("gone")), end["watermark"]
        if batch >= 0:
            raise ValueError(f"{self.to.known} has no table of batch {batch}, which the checkpoint has")
        return self.spark.createDataFrame([], self.shape), 0

    def late(self, rows: DataFrame, batch: int) -> None:
        numbered = rows.withColumn("batch", F.lit(batch).cast("bigint"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.to.late)


def _settle(known: _Known, keep_days: int) -> None:
    """At the end of a run, gives up what the watermark that its last batch left has passed."""
    ends = [x for x in (known.end(0), known.end(1)) if x is not None]
    last = max(ends, key=lambda x: x["batch"], default=None)
    done = known.end("end")
    if last is None or last["watermark"] == last["used"] or done is not None and done["batch"] == last["batch"]:
        return
    batch, watermark = last["batch"], last["watermark"]
    rows = known.read(batch % 2).where(F.col("order_id").isNotNull() & ~F.col("gone"))
    until = F.when(F.col("until") == 0, F.lit(watermark + keep_days * DAY)).otherwise(F.col("until"))
    rows = rows.withColumns({"until": until, "gone": until < watermark, "touched": F.lit(False)})
    known.late(_waited_in_vain(rows), -1 - batch)
    known.write(rows, "end", batch, watermark, watermark)


def update_daily(
    spark: SparkSession, raw: RawTables, to: DailyStream, series_col: str | None = None, fanout: str = "faithful", late_days: int = 7, keep_days: int = 30
) -> None:
    """Adds to the store all that the streams of ``raw`` have, and ends. Called again with
    the same ``to``, it goes on with what has come since; the options stay the same between
    calls.

    An order more than ``late_days`` behind the newest is late. Its items and payments may
    come before it or after, while the newest order less ``late_days`` is not ``keep_days``
    past it; then what is known of it goes. Within these bounds no sequence changes the sums.
    What is late adds nothing and is counted (``late_rows``). Each batch writes the table of
    the orders that may still change once, so few large batches cost less than many.
    """
    events = order_events(raw, series_col, fanout)
    empty = spark.createDataFrame([], STORED).drop("batch", "period")
    write_rollup(empty, to.rollup, to.unit, "ignore")
    key = StructField("order_id", events.schema["order_id"].dataType)

    def add(found: DataFrame, batch: int) -> None:
        session = found.sparkSession
        known = _Known(session, to, key)
        before, watermark = known.after(batch - 1)
        # Written once, as it is used for the late rows, the watermark and the sums.
        rows = new_steps(session, "daily-stream")(_added_up(found), "rows")
        newest = rows.agg(F.max("at_ms").alias("at_ms")).first()["at_ms"]
        left = watermark if newest is None else max(watermark, newest - late_days * DAY)
        known.write(_next(before, rows, watermark, keep_days), batch % 2, batch, watermark, left)
        now = known.read(batch % 2).where(F.col("order_id").isNotNull())
        late = rows.where(_is_late(watermark)).groupBy("series_id", "ds").agg(F.sum("n").alias("n"))
        late = late.select("series_id", "ds", F.lit(HEADER).alias("late"), "n")
        known.late(late.unionByName(_waited_in_vain(now)), batch)
        delta = _changes(now).withColumns({"dimension": F.lit(TOTAL), "segment": F.lit(None).cast("string")})
        update_rollup(session, to.rollup, delta, batch + 1, to.unit)

    known = _Known(spark, to, key)
    _settle(known, keep_days)
    stream = events.writeStream.outputMode("append").foreachBatch(add)
    stream.option("checkpointLocation", to.checkpoint).trigger(availableNow=True).start().awaitTermination()
    _settle(known, keep_days)


def late_rows(spark: SparkSession, to: DailyStream) -> DataFrame:
    """What came too late so far, one row per series, day and kind."""
    rows = spark.read.schema("series_id string, ds date, late string, n bigint, batch bigint").parquet(to.late)
    return rows.groupBy("series_id", "ds", "late").agg(F.sum("n").alias("n"))
