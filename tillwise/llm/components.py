"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.llm import common
from tillwise.operators.skew import join_per_key

MAX_ROUNDS = 50


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = join_per_key(both.where("v > u"), _least(both), "u")
    return joined.select(F.col("v").alias("u"), F.least("m", joined["u"]).alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = join_per_key(edges, _least(edges), "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(joined.select("u", F.col("m").alias("v"))).distinct())


def _mark(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
                     .alias("s")).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node of an undirected edge the smallest node it reaches.

    Loops, repeated and null edges are allowed and change nothing; no edges give no rows. Each
    round is written to the shared folder; it ends when a round leaves the stars as they were.
    """
    stars = common.stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(),
        "edges")
    mark = _mark(stars)
    for _ in range(MAX_ROUNDS):
        if mark.n == 0:
            break
        stars = common.stored(_small_star(_large_star(stars).distinct()), "stars")
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
