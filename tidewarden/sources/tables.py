"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import detectors_text
from ..operators.facts import RawTables

# File names of the raw tables, and the columns read of each.
RAW_FILES = {
    "orders": "olist_orders_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "products": "olist_products_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
}
RAW_COLUMNS = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
    },
    "customers": {"customer_id": "string", "customer_state": "string"},
    "items": {
        "order_id": "string",
        "product_id": "string",
        "price": "double",
        "freight_value": "double",
    },
    "products": {"product_id": "string", "product_category_name": "string"},
    "payments": {"order_id": "string", "payment_type": "string", "payment_value": "double"},
}
FORMATS = ("parquet", "csv", "orc", "json")


def read_raw_table(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """The needed columns of one raw table, by name and with their declared types.

    CSV columns are matched by header; nothing is inferred, so no extra pass over the
    data. Values that do not fit their type become NULL.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    df = reader.format(fmt).load(path)
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in RAW_COLUMNS[name].items()])


def read_raw(
    spark: SparkSession, raw_dir: str, files: Mapping[str, str] = RAW_FILES, fmt: str = "csv"
) -> RawTables:
    """The five inputs from a folder."""
    return RawTables(
        **{name: read_raw_table(spark, name, f"{raw_dir.rstrip('/')}/{files[name]}", fmt) for name in RAW_COLUMNS}
    )


def stage_raw(raw: RawTables, staging_dir: str) -> RawTables:
    """The inputs rewritten as Parquet, replacing an earlier staging, and read back: the
    text is parsed once, and later reads prune columns and skip row groups."""
    staged = {}
    for name in RAW_COLUMNS:
        df = getattr(raw, name)
        path = f"{staging_dir.rstrip('/')}/stg_{name}"
        df.write.mode("overwrite").parquet(path)
        staged[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return RawTables(**staged)


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as text, for formats that hold only text."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        kind = field.dataType.typeName()
        if field.name == "detectors" and kind == "struct":
            c = detectors_text(c).alias(field.name)
        elif kind in ("struct", "array", "map"):
            c = F.to_json(c, {"ignoreNullFields": "false"}).alias(field.name)
        out.append(c)
    return df.select(*out)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Writes a table, replacing what is there; an empty one keeps its columns."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    if fmt == "csv":
        df = _flat(df)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table written by ``write_table``, with a known schema."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(path)


def read_alerts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored alert table as it is; a path that does not exist is an error."""
    reader = spark.read
    if fmt == "csv":
        # Evidence text may hold line breaks and quotes.
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.format(fmt).load(path)


class Steps:
    """Tables between the steps of a job, in a folder all executors share.

    Calling it writes a table and returns it as a scan: what several steps read is
    computed once, and a lost executor costs a read, not the steps before.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def __call__(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = write_table(df, self.path(name), partition_by=partition_by)
        return df.sparkSession.read.schema(df.schema).parquet(path)
