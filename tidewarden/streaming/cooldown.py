"""The cooldown on a stream of alerts.

State is kept per metric of a series: the last date sent and the last date seen. It expires
by an event-time timer once no alert that the watermark admits could still be too close, so
it is bounded by the metrics that alerted lately.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..functions.columns import risk_rank

_STATE = "sent date, seen date"
_ORDER = ("__risk", "__z", "__value", "__text")


def _millis(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp() * 1000)


def _decider(cooldown_days: int, columns: list[str]):
    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        sent, seen = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches), ignore_index=True)
        rows = rows.sort_values(["ds", *_ORDER], ascending=[True, False, False, False, True], na_position="last", kind="stable")
        keep = []
        for day, alerts in rows.groupby("ds", sort=True):
            if seen is not None and (day < seen or (day == seen and cooldown_days > 0)):
                continue
            seen = day
            if cooldown_days <= 0:
                keep.append(alerts)
            elif sent is None or (day - sent).days >= cooldown_days:
                sent = day
                keep.append(alerts.head(1))
        if seen is not None:
            state.update((sent, seen))
            # Beyond this date nothing depends on the state: earlier alerts are late by then.
            until = _millis(max(seen, sent or seen) + timedelta(days=max(1, cooldown_days)))
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        if keep:
            yield pd.concat(keep)[columns]

    return decide


def stream_cooldown(alerts: DataFrame, cooldown_days: int = 3, late_days: int = 7) -> DataFrame:
    """The alerts of a stream that ``apply_cooldown`` would send, as they come.

    Alerts are decided when they arrive, in order of their dates. So the result is that of
    the batch form if the dates of a metric arrive in order and those of one day together;
    of these the strongest is sent, by the same rules. Defined otherwise: an alert earlier
    than, or on the day of, one already decided is late and is not sent, nor is one more
    than ``late_days`` behind the newest date of the stream, nor one without a date. With a
    cooldown of zero every dated alert that is not late is sent.
    """
    text = "message" if "message" in alerts.columns else "injected_label"
    order = (risk_rank(F.col("risk_level")), F.abs("z_score"), F.col("value"), F.col(text))
    rows = alerts.where(F.col("ds").isNotNull()).withColumns(dict(zip(_ORDER, order)))
    timed = rows.withColumn("__at", F.to_timestamp("ds")).withWatermark("__at", f"{late_days} days")
    grouped = timed.groupBy("series_id", "kpi")
    decide = _decider(cooldown_days, alerts.columns)
    return grouped.applyInPandasWithState(decide, StructType(alerts.schema.fields), _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def send_alerts(alerts: DataFrame, output: str, checkpoint: str, cooldown_days: int = 3, late_days: int = 7) -> None:
    """Decides all alerts that are there and appends those to send to a table. Called again
    with the same ``checkpoint``, it goes on with what has come since."""
    sent = stream_cooldown(alerts, cooldown_days, late_days)
    query = sent.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
