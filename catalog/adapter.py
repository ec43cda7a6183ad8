"""The five raw inputs as views over the test tables.

NULL categories, unpaid orders and double payments are deliberate: they exercise the
payment fan-out and the NULL segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.operators.facts import RawTables


# The columns read, declared so that no job is needed to look them up.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_tax double",
}


def cents(x: Column) -> Column:
    """Rounded to cents by arithmetic that every engine does alike; their rounding
    functions differ on values just below half a cent."""
    return F.floor(x * 100.0 + 0.5).cast("double") / 100.0


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    orders = table("orders")
    order_key = F.col("o_orderkey")
    payments = orders.where(order_key % 97 != 0).select(
        order_key.alias("order_id"),
        F.substring("o_orderpriority", 3, 100).alias("payment_type"),
        F.col("o_totalprice").alias("payment_value"),
    )
    vouchers = orders.where(order_key % 10 == 0).select(
        order_key.alias("order_id"),
        F.lit("voucher").alias("payment_type"),
        F.lit(10.0).alias("payment_value"),
    )
    return RawTables(
        orders=orders.select(
            order_key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "P", "canceled").otherwise("delivered").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        ),
        customers=table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state")),
        items=table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            cents(F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        ),
        products=table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") <= 2, None).otherwise(F.col("p_type")).alias("product_category_name"),
        ),
        payments=payments.unionByName(vouchers),
    )
