"""One pass from the raw tables to daily totals and daily segment metrics.

The mart repeats an order's items once per payment. Grouped by anything, its sums
factor by order: items are summed per order and item attribute, payments counted per
order and payment attribute, and a mart sum is a sum of products of the two. So the
mart need not be built: items and payments are reduced before they meet, with map-side
combining, and an order holding a large share of either is small by the time it is
joined. Totals and all dimensions then come out of one join on the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_DIMENSIONS
from ..functions.columns import lookup
from .bands import ORDER_SEGMENT, band, value_of
from .facts import RawTables, check_fanout, order_headers, order_payments, priced_items

SERIES = "all"
TOTAL = "__total__"

# Which input each mart column comes from.
HEADER_COLUMNS = ("order_id", "purchase_ts", "purchase_date", "order_status", "customer_state")
ITEM_COLUMNS = ("product_id", "price", "freight_value", "product_category_name")
PAYMENT_COLUMNS = ("payment_type", "payment_value")
MART_COLUMNS = HEADER_COLUMNS + ITEM_COLUMNS + PAYMENT_COLUMNS


def series_column(series_col: str | None) -> Column:
    """The key of a row's series; without a column all rows are one series."""
    return (F.col(series_col).cast("string") if series_col else F.lit(SERIES)).alias("series_id")


def segment_entry(dimension: str, segment: Column) -> Column:
    return F.struct(F.lit(dimension).alias("dimension"), segment.cast("string").alias("segment"))


def segment_entries(dimensions: Sequence[str]) -> list[Column]:
    """One (dimension, segment) per dimension of a row."""
    return [segment_entry(d, F.col(d)) for d in dimensions]


def _first(columns: Sequence[str], order: Sequence[str]) -> Column:
    """True on one row of an order for each combination of ``columns``, which start the
    list ``order``. Rows are sorted by order anyway to be joined, so this costs a scan."""
    w = Window.partitionBy("order_id").orderBy(*order)
    again = F.row_number().over(w) > 1
    for c in columns:
        again = again & F.lag(c).over(w).eqNullSafe(F.col(c))
    return ~again


def _parts(rows: DataFrame, dims: Sequence[str], measure: Column, name: str, flag: str) -> DataFrame:
    """A child table of the orders reduced to one row per order and combination of
    ``dims``. Each carries the measure of the whole order (``name``) and of each of its
    segments (``name_<dimension>``), and marks the one row of the order (``flag``) and of
    the segment (``flag_<dimension>``) to take it from."""
    parts = rows.groupBy("order_id", *dims).agg(measure.alias(name))
    if not dims:
        return parts.withColumn(flag, F.lit(True))
    if len(dims) > 1:
        # Moved by order alone, once, which serves the windows by segment as well.
        parts = parts.repartition("order_id")
    every = (Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.partitionBy("order_id").orderBy(*dims).rowsBetween(*every)
    out = [F.sum(name).over(order).alias(name), _first([], dims).alias(flag)]
    for d in dims:
        if len(dims) == 1:
            out += [F.col(name).alias(f"{name}_{d}"), F.lit(True).alias(f"{flag}_{d}")]
        else:
            segment = Window.partitionBy("order_id", d).orderBy(d).rowsBetween(*every)
            out += [F.sum(name).over(segment).alias(f"{name}_{d}"), _first([d], [d]).alias(f"{flag}_{d}")]
    return parts.select("order_id", *dims, *out)


def daily_rollup(
    raw: RawTables,
    dimensions: Sequence[str] = DEFAULT_DIMENSIONS,
    series_col: str | None = None,
    fanout: str = "faithful",
    order_cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Daily measures of each segment, and of the whole day under dimension ``TOTAL``.

    Columns: ``series_id, ds, dimension, segment, revenue`` (of delivered orders) and
    ``orders`` (distinct delivered), and for the whole day ``failed`` (distinct orders of
    another status) and ``total`` (distinct orders). ``series_col`` is an attribute of
    the order or its customer. The dimension ``order_segment`` bands orders by their value
    at ``order_cuts`` (see ``bands``); it costs no join, as an order's sum is at hand.

    Distinct orders are counted without another shuffle: the rows of an order are
    together when it is joined, so one row for each thing to count is marked there.
    """
    check_fanout(fanout)
    dimensions = list(dict.fromkeys(dimensions))
    unknown = set(dimensions) - {*MART_COLUMNS, ORDER_SEGMENT}
    if unknown:
        raise ValueError(f"no such mart column: {sorted(unknown)}")
    if ORDER_SEGMENT in dimensions and order_cuts is None:
        raise ValueError(f"{ORDER_SEGMENT} needs order_cuts")
    if series_col and series_col not in HEADER_COLUMNS:
        raise ValueError(f"series_col must be one of {HEADER_COLUMNS}")
    header_dims = [d for d in dimensions if d in HEADER_COLUMNS]
    item_dims = [d for d in dimensions if d in ITEM_COLUMNS]
    payment_dims = [d for d in dimensions if d in PAYMENT_COLUMNS]

    day_key, status_key = ["series_id", "ds"], ["series_id", "ds", "order_status"]
    order = [*status_key, *[f"seg_{d}" for d in header_dims[:1]]]
    headers = order_headers(raw).select(
        "order_id",
        series_column(series_col),
        F.col("purchase_date").alias("ds"),
        "order_status",
        *[F.col(d).cast("string").alias(f"seg_{d}") for d in header_dims],
    )
    headers = headers.select(
        "*",
        _first(day_key, order).alias("h_day"),
        _first(status_key, order).alias("h"),
        *[
            _first([*status_key, f"seg_{d}"], [*status_key, f"seg_{d}"]).alias(f"h_{d}")
            for d in header_dims
        ],
    )
    amount = F.sum(F.col("price") + F.col("freight_value"))
    items = _parts(priced_items(raw), item_dims, amount, "amount", "i")
    payments = _parts(order_payments(raw, fanout), payment_dims, F.count(F.lit(1)), "times", "p")
    joined = headers.join(items, "order_id").join(payments, "order_id", "left")

    def holds(name: str) -> Column:
        """A mark; those of a payment the order does not have hold."""
        return F.coalesce(F.col(name), F.lit(True))

    # Per dimension: its segment, the rows to take it from, the measure there, and
    # whether the order counts, which it does once although it may be listed repeatedly.
    times, once = F.coalesce("times", F.lit(1)), holds("i") & holds("p")
    whole = F.col("amount") * times
    entries = [(TOTAL, F.lit(None), once, whole, F.col("h"), F.col("h_day"))]
    never = F.lit(False)
    for d in header_dims:
        entries.append((d, F.col(f"seg_{d}"), once, whole, F.col(f"h_{d}"), never))
    if ORDER_SEGMENT in dimensions:
        segment = band(value_of(F.col("amount")), order_cuts)
        entries.append((ORDER_SEGMENT, segment, once, whole, F.col("h"), never))
    for d in item_dims:
        entries.append((d, F.col(d), holds(f"i_{d}") & holds("p"), F.col(f"amount_{d}") * times, F.col("h"), never))
    for d in payment_dims:
        part = F.col("amount") * F.coalesce(f"times_{d}", F.lit(1))
        entries.append((d, F.col(d), holds("i") & holds(f"p_{d}"), part, F.col("h"), never))

    # The columns of each entry are named by its position; so is its dimension until
    # the rows are grouped, as the name would be copied with every one of them.
    columns = [
        column.alias(f"{kind}{i}")
        for i, (_, segment, used, measure, counted, in_total) in enumerate(entries)
        for kind, column in zip(
            ("segment", "used", "amount", "counted", "total"),
            (segment.cast("string"), used, measure, counted, in_total),
        )
    ]
    key = ["series_id", "ds"] if series_col else ["ds"]
    delivered = F.col("order_status") == "delivered"
    sets = ", ".join(f"(segment{i}, used{i}, amount{i}, counted{i}, total{i}) AS `{i}`" for i in range(len(entries)))
    rows = joined.sparkSession.sql(
        "SELECT * FROM {rows} UNPIVOT INCLUDE NULLS "
        f"((segment, used, amount, counted, in_total) FOR entry IN ({sets}))",
        rows=joined.select(*key, delivered.alias("delivered"), *columns),
    ).where(F.col("used") & ((F.col("entry") == "0") | F.col("delivered")))
    grouped = rows.groupBy(*key, "entry", "segment").agg(
        F.sum(F.when(F.col("delivered"), F.col("amount")).otherwise(0.0)).alias("revenue"),
        F.count_if(F.col("delivered") & F.col("counted")).alias("orders"),
        F.count_if(~F.col("delivered") & F.col("counted")).alias("failed"),
        F.count_if("in_total").alias("total"),
    )
    names = {str(i): e[0] for i, e in enumerate(entries)}
    return grouped.select(
        F.col("series_id") if series_col else series_column(None),
        "ds",
        lookup(F.col("entry"), names, None).alias("dimension"),
        "segment",
        "revenue",
        "orders",
        "failed",
        "total",
    )


def segment_daily(
    facts: DataFrame, dimensions: Sequence[str] = DEFAULT_DIMENSIONS, series_col: str | None = None
) -> DataFrame:
    """Daily revenue and distinct orders of each segment, of the delivered rows of a mart.

    All dimensions in one pass, the distinct orders counted in two steps.
    """
    per_order = (
        facts.where(F.col("order_status") == "delivered")
        .select(
            series_column(series_col),
            F.col("purchase_date").alias("ds"),
            F.col("order_id").alias("counted_order"),
            (F.col("price") + F.col("freight_value")).alias("amount"),
            F.inline(F.array(*segment_entries(dimensions))),
        )
        .groupBy("series_id", "ds", "dimension", "segment", "counted_order")
        .agg(F.sum("amount").alias("amount"))
    )
    return per_order.groupBy("series_id", "ds", "dimension", "segment").agg(
        F.sum("amount").alias("revenue"), F.count("counted_order").alias("orders")
    )


def segment_daily_from_rollup(rollup: DataFrame) -> DataFrame:
    """The same from ``daily_rollup``."""
    return rollup.where(F.col("dimension") != TOTAL).select(
        "series_id", "ds", "dimension", "segment", "revenue", "orders"
    )
