"""The order-facts mart: one row per order, item and payment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day, number, timestamp

FANOUT = ("faithful", "dedup")
COLUMNS = (
    "order_id",
    "purchase_ts",
    "purchase_date",
    "order_status",
    "customer_state",
    "product_id",
    "price",
    "freight_value",
    "product_category_name",
    "payment_type",
    "payment_value",
)
HOT_ROWS = 100_000
SALTS = 32


@dataclass(frozen=True)
class RawTables:
    """The five inputs."""

    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    products: DataFrame
    payments: DataFrame


def check_fanout(fanout: str) -> None:
    if fanout not in FANOUT:
        raise ValueError(f"fanout must be one of {FANOUT}, not {fanout!r}")


def order_headers(raw: RawTables) -> DataFrame:
    """Orders with their customer's state; orders of unknown customers drop out."""
    orders = raw.orders.select(
        "order_id",
        "customer_id",
        timestamp(F.col("order_purchase_timestamp")).alias("purchase_ts"),
        day(F.col("order_purchase_timestamp")).alias("purchase_date"),
        "order_status",
    )
    customers = raw.customers.select("customer_id", "customer_state")
    return orders.join(customers, "customer_id").drop("customer_id")


def priced_items(raw: RawTables) -> DataFrame:
    """Order items with their product's category, NULL for unknown products.

    Joined before any other table, so that what is shuffled by product is as narrow
    as it can be; a product that a large share of the items name is split by the
    adaptive skew join, as nothing above relies on this partitioning.
    """
    items = raw.items.select(
        "order_id",
        "product_id",
        number(F.col("price")).alias("price"),
        number(F.col("freight_value")).alias("freight_value"),
    )
    products = raw.products.select("product_id", "product_category_name")
    return items.join(products, "product_id", "left")


def order_payments(raw: RawTables, fanout: str = "faithful") -> DataFrame:
    """Payment rows of the orders; ``dedup`` folds them into one row per order."""
    check_fanout(fanout)
    pay = raw.payments.select(
        "order_id", "payment_type", number(F.col("payment_value")).alias("payment_value")
    )
    if fanout == "faithful":
        return pay
    return pay.groupBy("order_id").agg(
        F.max_by("payment_type", F.struct(F.coalesce("payment_value", F.lit(float("-inf"))), "payment_type")).alias("payment_type"),
        F.sum("payment_value").alias("payment_value"),
    )


def hot_orders(raw: RawTables, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(order_id, many_items, many_payments)`` of orders with more than ``hot_rows`` rows
    of either: one in so many rows at most. Only ids are read, and counted before they move."""
    items = raw.items.select("order_id", F.lit(1).alias("item"), F.lit(0).alias("payment"))
    payments = raw.payments.select("order_id", F.lit(0).alias("item"), F.lit(1).alias("payment"))
    counts = items.unionByName(payments).groupBy("order_id").agg(F.sum("item").alias("items"), F.sum("payment").alias("payments"))
    many = [(F.col(c) > hot_rows).alias(f"many_{c}") for c in ("items", "payments")]
    return counts.select("order_id", *many).where("many_items OR many_payments")


def _spread(rows: DataFrame, hot: DataFrame, salt: str) -> DataFrame:
    """Rows with a salt, which deals those of a hot order out."""
    own = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    return rows.join(hot, "order_id", "left").withColumn(salt, F.when(F.col("hot"), own).otherwise(0)).drop("hot")


def _repeat(rows: DataFrame, hot: DataFrame, salt: str) -> DataFrame:
    """Rows once for each salt that rows of their order can have on the other side."""
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(hot, "order_id", "left").withColumn(salt, F.explode(salts))


def order_facts(raw: RawTables, fanout: str = "faithful", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The mart. An order with several payments repeats its items once for each
    (``faithful``); orders without items are not in it.

    Orders with very many items or payments are found first, by a count. Where there are
    some, they are dealt out by a salt and their other side is repeated, so that each is
    joined in ``SALTS`` tasks; where there are none, as nearly always, the joins are plain.
    """
    payments = order_payments(raw, fanout)
    hot = hot_orders(raw, hot_rows)
    if hot.isEmpty():
        return order_headers(raw).join(priced_items(raw), "order_id").join(payments, "order_id", "left").select(*COLUMNS)
    many_items, many_payments = (hot.where(f"many_{x}").select("order_id", F.lit(True).alias("hot")) for x in ("items", "payments"))
    items = _spread(priced_items(raw), many_items, "item_salt")
    lines = _repeat(order_headers(raw), many_items, "item_salt").drop("hot").join(items, ["order_id", "item_salt"])
    paid = _spread(payments, many_payments, "paid_salt").withColumn("paid", F.lit(True))
    paid = _repeat(paid, many_items, "item_salt").drop("hot")
    return (
        _repeat(lines, many_payments, "paid_salt")
        .join(paid, ["order_id", "item_salt", "paid_salt"], "left")
        # A salt that no payment of a hot order has stands for no missing payment.
        .where(F.col("paid").isNotNull() | F.col("hot").isNull())
        .select(*COLUMNS)
    )
