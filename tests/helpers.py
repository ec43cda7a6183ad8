"""Small inputs for tests."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidewarden.operators.facts import RawTables

SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string",
    "customers": "customer_id string, customer_state string",
    "items": "order_id string, product_id string, price double, freight_value double",
    "products": "product_id string, product_category_name string",
    "payments": "order_id string, payment_type string, payment_value double",
}
ALERT_SCHEMA = (
    "series_id string, ds date, kpi string, value double, baseline double, z_score double, "
    "risk_level string, detectors struct<rule:boolean,z:boolean,iqr:boolean,iforest:boolean>, "
    "root_cause_json string, validation_status string, injected_label string"
)


def d(n: int) -> date:
    """Day ``n`` of January 2018, counting on from there."""
    return date(2017, 12, 31) + timedelta(days=n)


def raw(spark: SparkSession, **tables: list[tuple]) -> RawTables:
    return RawTables(**{k: spark.createDataFrame(tables.get(k, []), s) for k, s in SCHEMAS.items()})


def long(spark: SparkSession, values: list, kpi: str = "revenue", series: str = "all") -> DataFrame:
    rows = [(series, d(i + 1), kpi, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ds date, kpi string, value double")


def wide(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (ds, revenue, orders, aov, payment_fail_rate)."""
    return spark.createDataFrame(
        [("all", *r) for r in rows],
        "series_id string, ds date, revenue double, orders double, aov double, payment_fail_rate double",
    )


def alerts(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "series_id": "all", "ds": d(1), "kpi": "revenue", "value": 1.0, "baseline": 1.0, "z_score": 3.0,
        "risk_level": "HIGH", "detectors": (True, True, False, False), "root_cause_json": None,
        "validation_status": "PASS", "injected_label": None,
    }
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], ALERT_SCHEMA)
