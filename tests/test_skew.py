"""Keys that hold a third of all rows or more."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_series import tidy
from tidewarden.operators.facts import RawTables, order_facts
from tidewarden.operators.kpis import kpi_daily, kpi_daily_from_rollup
from tidewarden.operators.rollup import daily_rollup, segment_daily, segment_daily_from_rollup

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark) -> RawTables:
    """Half of the items name one product, half of the orders one customer, and one order
    holds a third of the items and of the payments."""
    n = spark.range(0, 60_000, 1, 6)
    k = F.col("id")
    return RawTables(
        orders=spark.range(20_000).select(
            k.alias("order_id"),
            F.when(k % 2 == 0, 0).otherwise(k % 500).alias("customer_id"),
            F.when(k % 7 == 0, "canceled").otherwise("delivered").alias("order_status"),
            F.date_add(F.lit("2018-01-01").cast("date"), (k % 20).cast("int")).alias("order_purchase_timestamp"),
        ),
        customers=spark.range(500).select(k.alias("customer_id"), F.concat(F.lit("state"), k % 9).alias("customer_state")),
        items=n.select(
            F.when(k % 3 == 0, 1).otherwise(k % 20_000).alias("order_id"),
            F.when(k % 2 == 0, 1).otherwise(k % 900).alias("product_id"),
            (k % 100 / 4).alias("price"),
            F.lit(0.25).alias("freight_value"),
        ),
        products=spark.range(900).select(k.alias("product_id"), F.concat(F.lit("cat"), k % 30).alias("product_category_name")),
        payments=spark.range(30_000).select(
            F.when(k % 3 == 0, 2).otherwise(k % 15_000).alias("order_id"),
            F.concat(F.lit("type"), k % 4).alias("payment_type"),
            F.lit(1.0).alias("payment_value"),
        ),
    )


def test_hot_keys_are_split_and_results_are_whole(spark, small_limits):
    tables = hot(spark)
    rollup = daily_rollup(tables)
    rows = tidy(segment_daily_from_rollup(rollup), 3)
    rollup.collect()
    final = rollup._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "skew=true" in final

    facts = order_facts(tables)
    assert rows == tidy(segment_daily(facts), 3)
    assert tidy(kpi_daily_from_rollup(rollup), 3) == tidy(kpi_daily(facts), 3)


@pytest.mark.parametrize("hot_rows", [100, 100_000])
def test_the_mart_deals_a_hot_order_out(spark, small_limits, hot_rows):
    """Whole with and without salts; with them no task gets the order alone."""
    tables = hot(spark)
    facts = order_facts(tables, hot_rows=hot_rows)
    plain = (
        tables.orders.join(tables.customers, "customer_id")
        .join(tables.items, "order_id")
        .join(tables.products, "product_id", "left")
        .join(tables.payments, "order_id", "left")
    )
    def counts(df):
        return sorted(
            tuple(r)
            for r in df.groupBy("order_id")
            .agg(F.count("*"), F.count("payment_type"), F.countDistinct("product_id"), F.sum("price"))
            .where("order_id < 50")
            .collect()
        )

    assert counts(facts) == counts(plain)
    tasks = facts.where("order_id = 1").groupBy(F.spark_partition_id()).count().count()
    assert tasks > 1 if hot_rows == 100 else tasks >= 1


def test_a_hot_order_is_small_when_it_is_joined(spark, small_limits):
    """Nothing but its distinct segments is left of the order with a third of the items."""
    tables = hot(spark)
    rollup = daily_rollup(tables)
    rollup.collect()
    assert tables.items.where("order_id = 1").count() > 20_000
    text = rollup._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join Inner, (order_id")
    assert "Aggregate [order_id" in text[join:]
