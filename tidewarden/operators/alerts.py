"""Alerts: built from flagged values, filtered, spaced out, ranked and worded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.columns import (
    DETECTORS,
    day,
    detector_count,
    detector_count_of_text,
    detector_struct,
    detectors_from_text,
    is_true,
    join_same,
    number,
    risk_rank,
)
from ..functions.message import alert_message, root_cause_summary_json
from ..sources.shared import new_steps

# What makes an alert worth sending.
SENT_RISKS = ("HIGH", "MEDIUM")
SENT_ABS_Z = 2.5
MIN_DETECTORS = 2

# Columns of the notifications, in order.
NOTIFICATION_COLUMNS = (
    "series_id",
    "ds",
    "kpi",
    "risk_level",
    "value",
    "baseline",
    "z_score",
    "detector_count",
    "validation_status",
    "injected_label",
    "message",
)


def build_alerts(long: DataFrame, explained: DataFrame, status: DataFrame) -> DataFrame:
    """One row per flagged (day, metric). ``explained`` has ``root_cause_json`` per
    (series_id, ds), ``status`` the validation status per series."""
    flagged = long.where("anomaly_flag").select(
        "series_id",
        "ds",
        "kpi",
        "value",
        "baseline",
        F.col("z").alias("z_score"),
        "risk_level",
        detector_struct(**{d: F.col(f"anomaly_{d}") for d in DETECTORS}).alias("detectors"),
        "injected_label",
    )
    caused = join_same(flagged, explained.select("series_id", "ds", "root_cause_json"), ["series_id", "ds"], "left")
    return join_same(caused, status, ["series_id"], "left").select(
        "series_id",
        "ds",
        "kpi",
        "value",
        "baseline",
        "z_score",
        "risk_level",
        "detectors",
        "root_cause_json",
        "validation_status",
        "injected_label",
    )


def normalise_alerts(alerts: DataFrame) -> DataFrame:
    """An alert table with its declared types, whichever way it was stored: text columns
    are read back, unreadable dates and numbers become NULL."""
    has_series = "series_id" in alerts.columns
    stored_as_text = dict(alerts.dtypes)["detectors"] == "string"
    detectors = detectors_from_text(F.col("detectors")) if stored_as_text else F.col("detectors")
    absent = F.lit(None).cast("string")
    text = {
        c: (F.col(c) if c in alerts.columns else absent).alias(c)
        for c in ("kpi", "risk_level", "root_cause_json", "validation_status", "injected_label")
    }
    # Text may name detectors that the struct has no field for; they count as well.
    fired = detector_count_of_text(F.col("detectors")) if stored_as_text else detector_count(F.col("detectors"))
    return alerts.select(
        fired.alias("detector_count"),
        (F.col("series_id") if has_series else F.lit("all")).alias("series_id"),
        day(F.col("ds")).alias("ds"),
        text["kpi"],
        number(F.col("value")).alias("value"),
        number(F.col("baseline")).alias("baseline"),
        number(F.col("z_score")).alias("z_score"),
        text["risk_level"],
        detectors.alias("detectors"),
        text["root_cause_json"],
        text["validation_status"],
        text["injected_label"],
    )


def meaningful() -> Column:
    """The data passed validation, and the risk or the z-score is high enough."""
    failed = is_true(F.upper("validation_status") == "FAIL")
    strong = is_true(F.upper("risk_level").isin(*SENT_RISKS)) | is_true(F.abs("z_score") >= SENT_ABS_Z)
    return ~failed & strong


def worth_sending(alerts: DataFrame) -> Column:
    """Meaningful, and raised by at least two detectors."""
    return meaningful() & (_fired(alerts) >= MIN_DETECTORS)


def _fired(alerts: DataFrame) -> Column:
    """Stored alerts bring their count; for others it is that of the flags."""
    return F.col("detector_count") if "detector_count" in alerts.columns else detector_count(F.col("detectors"))


def meaningful_alerts(alerts: DataFrame) -> DataFrame:
    """The alerts worth sending, with ``detector_count``."""
    return alerts.where(worth_sending(alerts)).withColumn("detector_count", _fired(alerts))


def sent_dates(alerts: DataFrame, cooldown_days: int) -> DataFrame:
    """The dates on which each metric of each series may send.

    A date is kept if it is far enough from the last one *kept*, which is a fold over
    the ordered dates. Only distinct dates are folded, so the calendar bounds the array,
    and repeated alerts of a day are reduced before the shuffle.
    """
    none = F.array().cast("array<date>")

    def step(sent: Column, d: Column) -> Column:
        last = F.try_element_at(sent, F.lit(-1))
        due = last.isNull() | (F.datediff(d, last) >= cooldown_days)
        return F.when(due, F.array_append(sent, d)).otherwise(sent)

    dates = alerts.groupBy("series_id", "kpi").agg(F.sort_array(F.collect_set("ds")).alias("dates"))
    # With no date at all, one undated alert is sent; after a dated one, none is.
    undated = F.array(F.lit(None).cast("date"))
    kept = F.when(F.size("dates") == 0, undated).otherwise(F.aggregate("dates", none, step))
    return dates.select("series_id", "kpi", F.explode(kept).alias("ds"))


def sent_dates_by_jumps(alerts: DataFrame, cooldown_days: int) -> DataFrame:
    """The same for long histories: no row ever holds the dates of a metric.

    Each date points to the next that is far enough from it, and what is sent is what the
    first date leads to. Jumps over 1, 2, 4, ... pointers, each table made by joining the
    one before with itself, reach all of it in as many rounds as the logarithm of the
    dates sent. Rounds are tables; they end when no date has so many after it.
    """
    step = new_steps(alerts.sparkSession, "cooldown")
    keys = ["series_id", "kpi"]
    # Backwards, as a frame that starts at its partition's end is added to row by row.
    later = Window.partitionBy(*keys).orderBy(F.desc("__day")).rangeBetween(Window.unboundedPreceding, -max(1, cooldown_days))
    days = alerts.where(F.col("ds").isNotNull()).select(*keys, "ds").distinct().withColumn("__day", F.unix_date("ds"))
    jumps = days.select(*keys, "ds", F.min("ds").over(later).alias("to")).where(F.col("to").isNotNull())
    jumps = step(jumps, "jumps-0")
    # A metric without any date sends one undated alert.
    reached = [step(alerts.groupBy(*keys).agg(F.min("ds").alias("ds")), "reached-0")]
    while not jumps.isEmpty():
        n = len(reached)
        hops = join_same(reduce(DataFrame.unionByName, reached), jumps, [*keys, "ds"], "inner")
        reached.append(step(hops.select(*keys, F.col("to").alias("ds")), f"reached-{n}"))
        first = jumps.withColumnRenamed("to", "mid")
        second = jumps.withColumnRenamed("ds", "mid")
        jumps = step(join_same(first, second, [*keys, "mid"], "inner").select(*keys, "ds", "to"), f"jumps-{n}")
    return reduce(DataFrame.unionByName, reached)


def apply_cooldown(alerts: DataFrame, cooldown_days: int = 3, long_histories: bool = False) -> DataFrame:
    """Drops the alerts of a metric that follow a sent one too closely.

    Of several alerts of one metric on one day the strongest is the one sent. With
    ``long_histories`` dates are followed by joins, which pays where a metric alerted on
    many thousand days; the result is the same.
    """
    strongest = Window.partitionBy("series_id", "kpi", "ds").orderBy(
        F.desc(risk_rank(F.col("risk_level"))),
        F.desc_nulls_last(F.abs("z_score")),
        F.desc_nulls_last("value"),
        F.asc_nulls_last("message") if "message" in alerts.columns else F.asc_nulls_last("injected_label"),
    )
    one = F.col("nth") == 1
    if cooldown_days <= 0:
        one = one | F.col("ds").isNotNull()
    candidates = alerts.withColumn("nth", F.row_number().over(strongest)).where(one).drop("nth")
    dates = (sent_dates_by_jumps if long_histories else sent_dates)(alerts, cooldown_days).select(*[F.col(c).alias(f"sent_{c}") for c in ("series_id", "kpi", "ds")])
    same = [F.col(c).eqNullSafe(F.col(f"sent_{c}")) for c in ("series_id", "kpi", "ds")]
    return candidates.join(dates, same, "left_semi")


def prioritise(alerts: DataFrame) -> DataFrame:
    """Highest risk first, then largest z-score, then earliest; unknown values last."""
    return (
        alerts.withColumn("risk_rank", risk_rank(F.col("risk_level")))
        .withColumn("abs_z", F.abs("z_score"))
        .orderBy(
            F.desc("risk_rank"),
            F.desc_nulls_last("abs_z"),
            F.asc_nulls_last("ds"),
            F.asc_nulls_last("kpi"),
            F.asc_nulls_last("series_id"),
        )
    )


def with_message(alerts: DataFrame) -> DataFrame:
    text = alert_message(
        ds=F.col("ds"),
        kpi=F.col("kpi"),
        risk_level=F.col("risk_level"),
        value=F.col("value"),
        baseline=F.col("baseline"),
        z_score=F.col("z_score"),
        detectors=F.col("detectors"),
        validation_status=F.col("validation_status"),
        injected_label=F.col("injected_label"),
        summary=root_cause_summary_json(F.col("root_cause_json")),
    )
    return alerts.withColumn("message", text)


def notifications(alerts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """From alerts to notifications in priority order; no alerts give an empty table of
    the same columns."""
    sent = apply_cooldown(meaningful_alerts(alerts), cfg.cooldown_days)
    return with_message(prioritise(sent)).select(*NOTIFICATION_COLUMNS)
