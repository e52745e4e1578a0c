"""Joins with a key that holds most of the rows."""

import pytest
from pyspark.sql import Window, functions as F

from tillwise.operators.ranking import rank_within
from tillwise.operators.skew import join_per_key


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def rows(spark):
    """30,000 rows, two thirds of them with key h, some with no key."""
    n = F.col("id")
    key = F.when(n % 3 < 2, "h").when(n % 100 == 2, None).otherwise((n % 1000).cast("string"))
    return spark.range(0, 30_000, 1, 4).select(key.alias("k"), n.alias("row"))


@pytest.fixture
def values(rows):
    return rows.filter("k is null or k <> '5'").groupBy("k").agg(F.max("row").alias("top"))


def test_many_hot_keys_are_all_spread(no_broadcast):
    """500 equally hot keys, each dealt over every slice; nothing runs while the plan is built."""
    df = no_broadcast.range(0, 50_000).select((F.col("id") % 500).alias("k"), "id")
    found = join_per_key(df, df.groupBy("k").agg(F.max("id").alias("top")), "k", slices=4)
    parts = (df.withColumn("part", F.pmod(F.xxhash64("k", "id"), F.lit(4)))
             .groupBy("k").agg(F.countDistinct("part").alias("n")).agg(F.min("n")).first()[0])
    assert parts == 4 and found.count() == 50_000


def test_building_the_join_runs_no_job(spark, rows, values):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    join_per_key(rows, values, "k")
    assert set(tracker.getJobIdsForGroup(None)) == before


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_result_as_plain_join(no_broadcast, rows, values, how):
    mine = join_per_key(rows, values, "k", how)
    plain = rows.join(values, "k", how)
    assert mine.columns == plain.columns
    assert mine.exceptAll(plain).count() == 0 and plain.exceptAll(mine).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_spread_over_tasks(no_broadcast, rows, values, how):
    """No task gets more than half of the rows, though one key holds two thirds."""
    spark = no_broadcast
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in join_per_key(rows, values, "k", how)
                 .groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rank_in_bands_is_the_plain_rank(spark):
    special = [(None, "x", None), (None, "y", 1.0), ("g", "nan", float("nan")), ("g", "n1", None),
               ("g", "n2", None), ("g", "zero", 0.0), ("g", "minus", -5.0), ("g", "less", -5.5),
               ("g", "inf", float("inf")), ("g", "-inf", float("-inf")), ("g", "tiny", 1e-9), ("g", "big", 1e17)]
    n = F.col("id")
    df = (spark.range(0, 20_000).select(
        F.when(n % 3 == 0, "g").otherwise((n % 5).cast("string")).alias("grp"),
        n.cast("string").alias("name"), ((n * 7919) % 5003 / 100.0 + 100).alias("v"))
        .union(spark.createDataFrame(special, "grp string, name string, v double")))
    plain = df.withColumn("place", F.rank().over(
        Window.partitionBy("grp").orderBy(F.desc("v"))).cast("bigint"))
    mine = rank_within(df, "grp", "v", "place")
    assert mine.columns == plain.columns
    assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_repeated_values_never_pass_the_driver(spark, rows, values, how):
    """Small as they look here, repeated values are not broadcast."""
    found = join_per_key(rows, values, "k", how)
    assert found.count() == (rows if how == "left" else rows.where("k <> '5'")).count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
