"""Exact ranks, draws with replacement, clustered files, tables replaced at once, split CSV."""

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F
from rows import client, table, ts

from tillwise import schemas
from tillwise.operators.quality import drawn_sample
from tillwise.operators.ranking import rank_within
from tillwise.sources import csv_files, tables


# Rank -------------------------------------------------------------------------------------------

def test_values_of_all_sizes_are_ranked_exactly(spark):
    rng = random.Random(3)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.0, 1.0 + 2 ** -52, 1e308, -1e308, float("inf"), float("-inf"), float("nan"), None]
    rows = [(rng.choice(["a", "b", None, ""]), rng.choice(odd + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 9)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "grp string, v double").repartition(5)
    plain = df.withColumn("place", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("v"))).cast("bigint"))
    mine = rank_within(df, "grp", "v", "place")
    assert mine.columns == plain.columns
    assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()


def test_a_million_ties_are_one_row_of_the_ranking(spark):
    df = spark.range(1_000_002).select(F.lit("g").alias("grp"), "id", F.when(F.col("id") < 2, F.col("id") + 5.0).otherwise(3.0).alias("v"))
    ranked = rank_within(df, "grp", "v", "place")
    assert {(r.place, r.n) for r in ranked.groupBy("place").agg(F.count("*").alias("n")).collect()} == {(1, 1), (2, 1), (3, 1_000_000)}


# Draws ------------------------------------------------------------------------------------------

def items(spark, rows):
    return spark.createDataFrame(rows, "k string, v double")


def test_draws_are_the_same_in_any_layout_and_may_repeat(spark):
    rows = [(f"k{i % 900}", float(i % 7)) for i in range(2000)]
    first, second = (sorted(map(tuple, drawn_sample(items(spark, rows).repartition(n), ["k"], 3.0).collect())) for n in (1, 6))
    assert first == second and len(first) == 6000 and set(first) <= set(rows)
    # Drawn three times each on average, some far more often: no bound on a row's draws.
    assert max((n for n in Counter(first).values())) > 3 * 3
    other = sorted(map(tuple, drawn_sample(items(spark, rows), ["k"], 3.0, seed=7).collect()))
    assert other != first


def test_equal_rows_hold_as_many_places(spark):
    rows = [("hot", 1.0)] * 6000 + [(f"k{i}", None) for i in range(3000)]
    drawn = Counter(r.k == "hot" for r in drawn_sample(items(spark, rows), ["k"], 1.0).collect())
    assert drawn.total() == 9000 and abs(drawn[True] - 6000) < 5 * (9000 * 2 / 9) ** 0.5


def test_every_place_is_drawn_evenly(spark):
    rows = [(f"k{i}", 0.0) for i in range(50)]
    counts = Counter(r.k for r in drawn_sample(items(spark, rows), ["k"], 400.0).collect())
    assert counts.total() == 20_000 and len(counts) == 50
    assert sum((n - 400) ** 2 / 400 for n in counts.values()) < 95  # chi-squared of 49 degrees, one in 10,000


def test_draws_of_few_rows_and_none(spark):
    assert drawn_sample(items(spark, []), ["k"]).collect() == []
    assert [tuple(r) for r in drawn_sample(items(spark, [(None, None)]), ["k"]).collect()] == [(None, None)]


# Clustering -------------------------------------------------------------------------------------

@pytest.fixture
def small_files(spark):
    """Adaptive execution leaves the ranges as they are."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled",)
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "false")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_files_of_a_large_day_are_ranges_of_the_clustering_columns(spark, tmp_path, small_files):
    orders = spark.range(40_000).select(
        F.col("id").cast("string").alias("order_id"), F.concat(F.lit("c"), F.lpad((F.col("id") * 7919 % 500).cast("string"), 3, "0")).alias("client_id"),
        F.lit(ts("2024-03-01 10:00:00")).alias("order_date"), F.lit("x").alias("status"), F.lit("y").alias("payment_method"),
        F.lit("r").alias("region"), F.lit(1.0).alias("total_amount"))
    tables.write_table(orders, "orders", str(tmp_path / "orders"))
    files = list((tmp_path / "orders" / "day=2024-03-01").glob("*.parquet"))
    assert len(files) >= 6
    spans = []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("client_id")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    for wanted in ("c000", "c123", "c250", "c499"):
        assert sum(low <= wanted <= high for low, high in spans) <= 2


def test_one_hot_client_fills_many_files(spark, tmp_path, small_files):
    views = spark.range(20_000).select(
        F.col("id").cast("string").alias("session_id"), F.lit("c1").alias("client_id"), F.lit("home").alias("page"),
        F.lit(ts("2024-03-01 10:00:00")).alias("event_datetime"), F.lit(1.0).alias("duration_seconds"),
        *(F.lit("x").alias(c) for c in ("device", "browser", "traffic_source")))
    tables.write_table(views, "page_views", str(tmp_path / "v"))
    rows = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "v" / "day=2024-03-01").glob("*.parquet")]
    assert sum(rows) == 20_000 and max(rows) < 20_000 / 3


# Replacing --------------------------------------------------------------------------------------

def test_failed_load_leaves_the_old_rows(spark, tmp_path):
    base, database = str(tmp_path), "replaced_test"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    try:
        def load(*rows):
            tables.replace_table(spark, database, base, "clients", table(spark, "clients", *rows))

        def names():
            return sorted(r.client_id for r in spark.table(f"{database}.clients").collect())

        load(client("a"), client("b"))
        held = spark.table(f"{database}.clients")
        assert names() == ["a", "b"]
        bad = table(spark, "clients", client("c"), client("d")).withColumn(
            "email", F.when(F.col("client_id") == "d", F.raise_error(F.lit("lost"))).otherwise(F.col("email")))
        for _ in range(2):
            with pytest.raises(PySparkException):
                tables.replace_table(spark, database, base, "clients", bad)
            assert names() == ["a", "b"]
        load(client("e"))
        assert names() == ["e"]
        assert sorted(r.client_id for r in held.collect()) == ["a", "b"]  # a query that was running
        load(client("f", registration_date=None), client("f"))
        assert names() == ["f", "f"]
        kept = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if "__v" in r.tableName]
        assert len(kept) == 2 and len(list(tmp_path.glob("clients__v*"))) == 2
        shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.clients").collect()}
        assert shown["pii"] == "true" and shown["domain"] == "customer"
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


# CSV --------------------------------------------------------------------------------------------

@pytest.fixture(params=["64m", "37b"])
def splits(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def same_rows(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_split_files_are_read_as_whole_ones(spark, tmp_path, splits):
    odd = ["plain", "two\nlines", 'say "hi"', '"', "\n", "\n\n\n\"\n", "a,b", "", None, "é\n日本", "long " * 30 + "\n" + "cell " * 30,
           '""\n""', "x\n,\n,y", " lead", "\ttab"]
    rows = [client(f"c{i}", last_name=odd[i % len(odd)], city=odd[(i * 7 + 3) % len(odd)], age=i / 4) for i in range(60)]
    df = table(spark, "clients", *rows)
    csv_files.write_csv(df.coalesce(1), str(tmp_path / "one"))
    csv_files.write_csv(df.repartition(3), str(tmp_path / "three"))
    for name in ("one", "three"):
        got = csv_files.load_csv_split(spark, schemas.CLIENTS, str(tmp_path / name))
        assert got.columns == schemas.CLIENTS.fieldNames() and same_rows(got, df)
        assert same_rows(got, csv_files.load_csv(spark, schemas.CLIENTS, str(tmp_path / name)))
    if splits == "37b":
        lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "one"))
        assert lines.rdd.getNumPartitions() > 50


def test_split_file_with_carriage_returns_no_rows_and_a_wrong_cell(spark, tmp_path, splits):
    schema = schemas._schema("a string, b bigint")
    (tmp_path / "r.csv").write_bytes(b'a,b\r\n"x\r\ny",1\r\n\r\nz,2\r\n"last ""one""",3')
    got = csv_files.load_csv_split(spark, schema, str(tmp_path / "r.csv"))
    assert sorted((r.a, r.b) for r in got.collect()) == [('last "one"', 3), ("x\r\ny", 1), ("z", 2)]
    (tmp_path / "none.csv").write_text("a,b\n")
    assert csv_files.load_csv_split(spark, schema, str(tmp_path / "none.csv")).collect() == []
    (tmp_path / "bad.csv").write_text("a,b\nx,many\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv_files.load_csv_split(spark, schema, str(tmp_path / "bad.csv")).collect()
