"""Where intermediate tables and streaming checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local[...] session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="tillwise-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own for one run; it does not exist yet."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result once and go on from the table."""
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
