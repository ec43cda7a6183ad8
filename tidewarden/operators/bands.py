"""The order segment: bands of order value, derived from the data.

An order's value is the sum of its items with freight. Cuts between bands are quantiles of
all orders' values. They come from a sketch, made by partial aggregates and mergeable, so
that yesterday's can be kept and today's added; or exactly, by counting values in ever
narrower bins, which takes a few passes over one number per order and returns a bounded
number of counts each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .facts import RawTables, priced_items

ORDER_SEGMENT = "order_segment"
SKETCH_SIZE = 1024
"""Parameter k of the sketch: ranks are off by about 0.3 % at this size."""
BINS = 1024


def value_of(amount: Column) -> Column:
    """An order's value from the sum of its items, free of what the order of adding does."""
    return F.round(amount, 6)


def order_values(raw: RawTables) -> DataFrame:
    """``(order_id, value)`` of every order with items; NULL if no item has a price."""
    items = priced_items(raw)
    return items.groupBy("order_id").agg(value_of(F.sum(F.col("price") + F.col("freight_value"))).alias("value"))


def value_sketch(values: DataFrame, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """One mergeable sketch of the values per group ``by`` (of all, without): ``(by, sketch)``."""
    known = values.where(F.col("value").isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double("value", size).alias("sketch"))


def cuts_of_sketches(sketches: DataFrame, bands: int = 4, size: int = SKETCH_SIZE) -> list[float]:
    """Cuts into ``bands`` of about equal numbers, of the merged sketches; none of none."""
    sketches = sketches.where(F.kll_sketch_get_n_double("sketch") > 0)
    if bands < 2 or sketches.isEmpty():
        return []
    shares = F.array(*[F.lit(i / bands) for i in range(1, bands)])
    merged = sketches.agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return list(merged.select(F.kll_sketch_get_quantile_double("sketch", shares).alias("cuts")).first()["cuts"])


def exact_cuts(values: DataFrame, bands: int = 4, bins: int = BINS) -> list[float]:
    """Cut i is the value of rank ``ceil(n * i / bands)`` of n known values."""
    known = values.where(F.col("value").isNotNull()).select(F.col("value").cast("double"))
    whole = known.agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).first()
    n = whole["n"]
    if bands < 2 or not n:
        return []
    # Of each cut: the range its value lies in, and its rank among the values there.
    open_ = {i: (whole["low"], whole["high"], math.ceil(n * i / bands)) for i in range(1, bands)}
    cuts: dict[int, float] = {}
    while open_:
        for i in [i for i, (low, high, _) in open_.items() if low == high]:
            cuts[i] = open_.pop(i)[0]
        if not open_:
            break
        places = []
        for i, (low, high, _) in open_.items():
            # By halves, so that the width of the widest range is a number too.
            at = F.floor((F.col("value") / 2 - low / 2) / (high / 2 - low / 2) * bins)
            inside = (F.col("value") >= low) & (F.col("value") <= high)
            places.append(F.struct(F.lit(i).alias("cut"), F.when(inside, F.least(at, F.lit(bins - 1))).alias("bin")))
        binned = known.select("value", F.inline(F.array(*places))).where(F.col("bin").isNotNull())
        counts = binned.groupBy("cut", "bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        for row in sorted(counts.collect(), key=lambda r: (r["cut"], r["bin"])):  # (bands - 1) x bins at most
            low, high, rank = open_[row["cut"]]
            if rank <= 0:
                continue
            if rank <= row["n"]:
                open_[row["cut"]] = (row["low"], row["high"], -rank)
            else:
                open_[row["cut"]] = (low, high, rank - row["n"])
        open_ = {i: (low, high, abs(rank)) for i, (low, high, rank) in open_.items()}
    return [cuts[i] for i in sorted(cuts)]


def band(value: Column, cuts: Sequence[float]) -> Column:
    """``"1 of 4"`` for values up to the first cut, and so on; NULL for no value."""
    n = len(cuts) + 1
    name = F.lit(f"{n} of {n}")
    for i, cut in reversed(list(enumerate(cuts, 1))):
        name = F.when(value <= cut, f"{i} of {n}").otherwise(name)
    return F.when(value.isNotNull(), name)


def with_order_segment(facts: DataFrame, raw: RawTables, cuts: Sequence[float]) -> DataFrame:
    """A mart with the column ``order_segment``."""
    segments = order_values(raw).select("order_id", band(F.col("value"), cuts).alias(ORDER_SEGMENT))
    return facts.join(segments, "order_id", "left")
