"""The roll-up by signed changes, and alerts on a stream."""

from __future__ import annotations

import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalog.adapter import raw_tables
from tests.helpers import ALERT_SCHEMA, alerts, d, raw
from tests.test_plans import SF, folder
from tidewarden.operators.alerts import apply_cooldown
from tidewarden.operators.incremental import read_rollup, rollup_delta, update_rollup, with_changes, write_rollup
from tidewarden.operators.rollup import daily_rollup
from tidewarden.streaming.cooldown import send_alerts

DIMS = ("customer_state", "product_category_name", "payment_type")


def rows(df):
    return sorted(
        (str(r["ds"]), str(r["series_id"]), r["dimension"], str(r["segment"]), round(r["revenue"] or 0.0, 2), r["orders"], r["failed"], r["total"])
        for r in df.collect()
    )


def shop(spark, orders, payments=(), **changes):
    """Orders ``(id, customer, status, day, price)``, each of one item."""
    return raw(
        spark,
        orders=[(i, c, s, None if n is None else f"{d(n)} 12:00:00") for i, c, s, n, _ in orders],
        customers=[("c1", "SP"), ("c2", "RJ"), ("c3", None)],
        items=[(i, "p1" if i < "o5" else "p2", p, 1.0) for i, _, _, _, p in orders],
        products=[("p1", "toys"), ("p2", None)],
        payments=list(payments),
    )


START = [("o1", "c1", "delivered", 1, 10.0), ("o2", "c2", "delivered", 1, 20.0), ("o3", "c1", "canceled", 2, 30.0), ("o6", "c3", "delivered", 3, 60.0), ("o7", "c1", "delivered", None, 70.0)]
PAID = [("o1", "card", 1.0), ("o2", "card", 1.0), ("o2", "voucher", 1.0), ("o6", "card", 1.0)]


@pytest.mark.parametrize("series_col", [None, "customer_state"])
def test_inserts_late_payments_status_changes_and_deletions(spark, series_col):
    before, path = shop(spark, START, PAID), folder()
    options = {"series_col": series_col}
    write_rollup(daily_rollup(before, DIMS, **options), path, "day")
    assert rows(read_rollup(spark, path)) == rows(daily_rollup(before, DIMS, **options))
    batches = [
        # An order inserted, one paid late a second time.
        (["o4", "o1"], [("o4", "c2", "delivered", 4, 40.0), START[0]], [*PAID[:1], ("o1", "voucher", 1.0)]),
        # One delivered after all, one moved to another day, one that loses its date's only order.
        (["o3", "o2", "o6"], [("o3", "c1", "delivered", 2, 30.0), ("o2", "c2", "delivered", 3, 25.0)], PAID[1:3]),
        # The one without a date gets one; an unknown order is named too.
        (["o7", "none"], [("o7", "c1", "delivered", 1, 70.0)], []),
        # Nothing changes.
        (["o7"], [("o7", "c1", "delivered", 1, 70.0)], []),
    ]
    now = before
    for n, (ids, orders, payments) in enumerate(batches, 1):
        changed = spark.createDataFrame([(i,) for i in ids], "order_id string")
        after = with_changes(now, shop(spark, orders, payments), changed)
        delta = rollup_delta(now, after, changed, DIMS, **options)
        days = update_rollup(spark, path, delta, n, "day")
        assert (days == 0) == (n == 4)
        want = rows(daily_rollup(after, DIMS, **options))
        assert rows(read_rollup(spark, path)) == want
        assert update_rollup(spark, path, delta, n, "day") == 0 and rows(read_rollup(spark, path)) == want
        now = after


def test_only_touched_periods_are_written_and_read(spark):
    whole, path = raw_tables(spark, SF), folder()
    write_rollup(daily_rollup(whole, DIMS), path)
    before = {p: {f.name for f in os.scandir(f"{path}/{p}") if f.name.endswith("parquet")} for p in os.listdir(path) if p.startswith("period=")}
    own = whole.orders.where("order_id % 500 = 1")
    after = replace(whole, orders=whole.orders.withColumn("order_status", F.when(F.col("order_id") % 500 == 1, "canceled").otherwise(F.col("order_status"))))
    delta = rollup_delta(whole, after, own.select("order_id"), DIMS)
    days = {r["ds"] for r in delta.select("ds").distinct().collect()}
    months = {f"period={x.replace(day=1)}" for x in days}
    assert 0 < update_rollup(spark, path, delta, 1) == len(months) < len(before)
    assert rows(read_rollup(spark, path)) == rows(daily_rollup(after, DIMS))
    now = {p: {f.name for f in os.scandir(f"{path}/{p}") if f.name.endswith("parquet")} for p in before}
    assert {p for p in now if now[p] != before[p]} == months
    with pytest.raises(ValueError):
        update_rollup(spark, path, delta, 2, "week")


def sent(spark, path):
    return sorted(map(str, spark.read.schema(ALERT_SCHEMA).parquet(path).collect()))


def test_stream_sends_what_the_batch_form_sends(spark):
    rng = random.Random(4)
    days = [
        {"series_id": rng.choice(["a", "b", None]), "kpi": rng.choice(["revenue", "orders"]), "ds": d(n), "z_score": rng.choice([None, -3.0, 2.0]),
         "risk_level": rng.choice(["HIGH", "LOW"]), "value": float(i), "injected_label": str(i)}
        for n in range(1, 41) for i in range(rng.randint(0, 4))
    ]
    for cooldown in (3, 0):
        source, out, checkpoint = folder(), folder(), folder()
        stream = spark.readStream.schema(ALERT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        for part in range(4):
            own = [r for r in days if 10 * part < (r["ds"] - d(0)).days <= 10 * part + 10]
            alerts(spark, own).coalesce(1).write.mode("append").parquet(source)
            # Each call is a restart from the checkpoint.
            send_alerts(stream, out, checkpoint, cooldown)
        assert sent(spark, out) == sorted(map(str, apply_cooldown(alerts(spark, days), cooldown).collect()))


def test_late_and_undated_alerts_of_a_stream(spark):
    source, out, checkpoint = folder(), folder(), folder()
    stream = spark.readStream.schema(ALERT_SCHEMA).parquet(source)
    got = []
    for own in ([{"ds": d(20)}, {"ds": None}, {"ds": d(20), "kpi": "aov"}], [{"ds": d(18)}, {"ds": d(20), "z_score": 9.0}, {"ds": d(22)}, {"ds": d(23)}, {"ds": d(19), "kpi": "orders"}], [{"ds": d(40)}], [{"ds": d(24), "kpi": "orders"}]):
        alerts(spark, own).coalesce(1).write.mode("append").parquet(source)
        send_alerts(stream, out, checkpoint, 3, late_days=7)
        got = sorted((r["kpi"], r["ds"]) for r in spark.read.schema(ALERT_SCHEMA).parquet(out).collect())
    assert got == [("aov", d(20)), ("orders", d(19)), ("revenue", d(20)), ("revenue", d(23)), ("revenue", d(40))]
