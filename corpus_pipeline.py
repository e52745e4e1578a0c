"""Documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import common, stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("secrets", stages.secrets),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

# A nearest-neighbour classifier, MinHash and a packing have no SQL; brute-force tests stand in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
