"""Rolling statistics of long-form series.

Frames count rows and include the current one; a missing date widens a frame, and a
NULL value in it makes the statistic NULL. All frames share one partitioning and sort.
A partition is one metric of one series, so its size is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import ratio

ROLLING_COLUMNS = ("rolling_mean", "rolling_std", "baseline", "z", "iqr_lo", "iqr_hi")


def _series():
    return Window.partitionBy("series_id", "kpi").orderBy(F.asc_nulls_last("ds"))


def _full(n: int, stat: Column) -> Column:
    """A statistic over the last ``n`` rows, once all ``n`` have a value."""
    w = _series().rowsBetween(-(n - 1), 0)
    return F.when(F.count("value").over(w) == n, stat.over(w))


def add_rolling_stats(long: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Adds row position, rolling mean and standard deviation (population), baseline
    mean, z-score, and the interquartile fences (quartiles interpolated linearly)."""
    quartiles = F.percentile("value", F.array(F.lit(0.25), F.lit(0.75)))
    stats = long.select(
        "*",
        (F.row_number().over(_series()) - 1).alias("row_pos"),
        _full(cfg.mean_rows, F.avg("value")).alias("rolling_mean"),
        _full(cfg.std_rows, F.stddev_pop("value")).alias("rolling_std"),
        _full(cfg.baseline_rows, F.avg("value")).alias("baseline"),
        _full(cfg.baseline_rows, quartiles).alias("q"),
    )
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    return stats.select(
        *[c for c in stats.columns if c != "q"],
        ratio(F.col("value") - F.col("rolling_mean"), F.col("rolling_std")).alias("z"),
        (q1 - cfg.iqr_k * (q3 - q1)).alias("iqr_lo"),
        (q3 + cfg.iqr_k * (q3 - q1)).alias("iqr_hi"),
    )


def fill_gaps(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values take the last value before them or, at the start of a series, the
    first value there is."""
    w = Window.partitionBy("series_id").orderBy(F.asc_nulls_last("ds"))
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    # After the forward fill only leading values are missing, so the series' first
    # value serves; a frame that starts at each row would cost the square of its length.
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(F.last(c, True).over(so_far), F.first(c, True).over(whole)).alias(c)
        for c in columns
    }
    return wide.select(*[filled.get(c, F.col(c)) for c in wide.columns])
