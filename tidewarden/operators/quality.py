"""Data-quality report of daily series, and the status that gates detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_KPIS
from ..functions.columns import number, percent
from .rollup import SERIES

# Checks, limits and wording of the report.
REQUIRED = ("ds", *DEFAULT_KPIS)
NEGATIVE_CHECKED = ("revenue", "orders")
MAX_NULL_RATE = 0.02
MAX_GAP_DAYS = 2
STATUS = ("PASS", "WARN", "FAIL")
MISSING = "Missing: {}"
DS_NULLS = "ds contains nulls"
DUPLICATES = " duplicate dates"
NEGATIVE = " days with {} < 0"
NULL_RATE = "{} null rate = "
GAP = ("Max gap between dates = ", " days")
CLEAN = ("all", "PASS", "No issues detected")


def quality_report(wide: DataFrame) -> DataFrame:
    """Issues found, as ``(series_id, check, severity, detail)``; a clean series has one
    PASS row. An input without rows is one series without days: missing columns are
    reported for it, and otherwise it is clean.

    Rows are first reduced per day, so repeated or missing dates do not pile up in one
    task, and the gap search sees each date once.
    """
    missing = sorted(set(REQUIRED) - set(wide.columns))
    has_ds = "ds" in wide.columns
    kpis = [k for k in DEFAULT_KPIS if k in wide.columns]
    negative = [k for k in NEGATIVE_CHECKED if k in kpis]

    key = ["series_id", "ds"] if has_ds else ["series_id"]
    values = wide.select(*key, *[number(F.col(k)).alias(k) for k in kpis])
    per_day = values.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(k) < 0).alias(f"neg_{k}") for k in negative],
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in kpis],
    )
    date_stats: list[Column] = []
    if has_ds:
        w = Window.partitionBy("series_id").orderBy(F.asc_nulls_last("ds"))
        per_day = per_day.withColumn("gap", F.datediff("ds", F.lag("ds").over(w)))
        date_stats = [
            F.coalesce(F.sum(F.when(F.col("ds").isNull(), F.col("n"))), F.lit(0)).alias("null_ds"),
            F.sum(F.col("n") - 1).alias("dup_ds"),
            F.max("gap").alias("gap"),
        ]
    stats = per_day.groupBy("series_id").agg(
        F.sum("n").alias("n"),
        *date_stats,
        *[F.sum(f"neg_{k}").alias(f"neg_{k}") for k in negative],
        *[F.sum(f"null_{k}").alias(f"null_{k}") for k in kpis],
    )

    # One row if, and only if, the input has none.
    nothing = wide.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0).select(
        F.lit(SERIES).alias("series_id"),
        *[F.lit(0).cast("bigint").alias(c) for c in stats.columns if c not in ("series_id", "gap")],
        *[F.lit(None).cast("int").alias(c) for c in stats.columns if c == "gap"],
    )
    stats = stats.unionByName(nothing)

    issues: list[Column] = []

    def issue(when: Column, check: str, severity: str, detail: Column) -> None:
        entry = F.struct(
            F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.alias("detail")
        )
        issues.append(F.when(when, entry))

    if missing:
        issue(F.lit(True), "schema_required_cols", "FAIL", F.lit(MISSING.format(missing)))
    if has_ds:
        issue(F.col("null_ds") > 0, "ds_nulls", "FAIL", F.lit(DS_NULLS))
        issue(F.col("dup_ds") > 0, "ds_duplicates", "FAIL", F.concat(F.col("dup_ds").cast("string"), F.lit(DUPLICATES)))
    for k in negative:
        n = F.col(f"neg_{k}")
        issue(n > 0, f"{k}_negative", "FAIL", F.concat(n.cast("string"), F.lit(NEGATIVE.format(k))))
    for k in kpis:
        rate = F.try_divide(F.col(f"null_{k}").cast("double"), F.col("n"))
        issue(rate > MAX_NULL_RATE, f"null_rate_{k}", "WARN", F.concat(F.lit(NULL_RATE.format(k)), percent(rate, 2)))
    if has_ds:
        issue(
            F.col("gap") > MAX_GAP_DAYS,
            "date_gaps",
            "WARN",
            F.concat(F.lit(GAP[0]), F.col("gap").cast("string"), F.lit(GAP[1])),
        )
    found = F.array_compact(F.array(*issues))
    clean = F.array(
        F.struct(
            F.lit(CLEAN[0]).alias("check"),
            F.lit(CLEAN[1]).alias("severity"),
            F.lit(CLEAN[2]).alias("detail"),
        )
    )
    return stats.select("series_id", F.inline(F.when(F.size(found) > 0, found).otherwise(clean)))


def quality_status(report: DataFrame) -> DataFrame:
    """The worst severity of each series, as ``(series_id, validation_status)``."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS]), F.col("severity"))
    return report.groupBy("series_id").agg(F.max(rank).alias("rank")).select(
        "series_id",
        F.get(F.array(*[F.lit(s) for s in STATUS]), (F.col("rank") - 1).cast("int")).alias("validation_status"),
    )
