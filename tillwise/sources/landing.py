"""Bulk landing of a folder of CSV files in a raw Parquet zone, with a manifest."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import schemas
from tillwise.sources.csv_files import load_csv, load_text, write_csv

# Tables that land at the same time.
SIDE_BY_SIDE = 8


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV file below a folder: table, file name and size. Contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.csv").load(folder))
    return files.select(
        F.regexp_extract("path", r"/([^/]+?)\.csv(?:/[^/]+)?$", 1).alias("table_name"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("length").alias("source_bytes"))


def landed(spark: SparkSession, table: str, source: str) -> DataFrame:
    """One table's CSV files; every row keeps the name and size of its file. A table the data model
    does not know comes as text, under the names in its header."""
    rows = (load_csv(spark, schemas.TABLES[table], source) if table in schemas.TABLES
            else load_text(spark, source))
    return rows.select("*", F.col("_metadata.file_name").alias("source_file"),
                       F.col("_metadata.file_size").alias("source_bytes"))


def land_csv(spark: SparkSession, table: str, source: str, zone: str) -> None:
    """One table's CSV files to Parquet."""
    landed(spark, table, source).write.mode("overwrite").parquet(f"{zone}/{table}")


def write_folder(tables: dict[str, DataFrame], folder: str) -> None:
    """Every table as ``<table>.csv`` in one folder."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}.csv")


def land_folder(spark: SparkSession, folder: str, zone: str) -> DataFrame:
    """Land every ``<table>.csv`` of a folder (a file, or a folder of part files) and return the
    manifest: each file with its size and number of rows, also those without rows. Tables land side
    by side, so a small one does not wait for a large one."""
    files = listing(spark, folder)
    # One name per table reaches the driver.
    tables = sorted(r.table_name for r in files.select("table_name").distinct().collect())
    if not tables:
        return files.withColumn("n_rows", F.lit(0).cast("bigint"))
    writers = {name: landed(spark, name, f"{folder}/{name}.csv").write.mode("overwrite") for name in tables}
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        list(pool.map(lambda name: writers[name].parquet(f"{zone}/{name}"), tables))
    counts = reduce(DataFrame.unionByName, (
        spark.read.parquet(f"{zone}/{table}").groupBy("source_file").agg(F.count("*").alias("n_rows"))
        .withColumn("table_name", F.lit(table)) for table in tables))
    return files.join(counts, ["table_name", "source_file"], "left").select(
        "table_name", "source_file", "source_bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
