"""The folder that all executors share, for tables between the steps of a job."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from .tables import Steps


def shared_folder(spark: SparkSession, name: str = "tables") -> str:
    """A new folder in ``spark.checkpoint.dir``. Where that is unset it is in the warehouse,
    which must then lie in a shared store, unless all runs on one machine. Whoever asked
    for the folder clears it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if on_one_disk(warehouse) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{warehouse}/_steps"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_one_disk(path: str) -> bool:
    """Whether a path names a disk of the machine that reads it."""
    return path.startswith("file:") or "://" not in path and not path.startswith("hdfs:")


def new_steps(spark: SparkSession, name: str = "steps") -> Steps:
    """Tables between steps, in a new shared folder."""
    return Steps(shared_folder(spark, name))
