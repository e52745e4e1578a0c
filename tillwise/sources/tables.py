"""Parquet tables: day partitions, clustering, DDL and pruned reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import schemas

# Day column and clustering columns of each table.
LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "clients": ("registration_date", ("country", "segment")),
    "products": (None, ()),
    "orders": ("order_date", ("client_id", "region")),
    "order_items": (None, ()),
    "incidents": ("report_date", ("status", "priority")),
    "page_views": ("event_datetime", ("client_id", "page")),
}

# Description, domain label and whether the table holds personal data.
LABELS = {
    "clients": ("One row per client: name, contact, place, registration, segment", "customer", True),
    "products": ("What the shop sells, at which price, and how many are in stock", "product", False),
    "orders": ("Orders placed, their state, payment and total", "order", False),
    "order_items": ("Products in an order, with quantity and price paid", "order", False),
    "incidents": ("Complaints to customer support and how they ended", "support", False),
    "page_views": ("Pages seen in the web shop, by whom and on which device", "web_analytics", False),
}


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """Rows ready to be written: a ``day`` column, and each file a range of days and clustering columns.

    Rows are dealt to tasks by ranges, so a day that is too large for one task is cut where its
    clustering columns change, and a filter on these finds most of its files out of range; small days
    share a task. Rows that agree in all of them are told apart by a hash, so they fill as many tasks
    as they need. Tables without clustering columns are only written in files of a proper size.
    """
    day, cluster = LAYOUT[table]
    if not day:
        return df.hint("rebalance")
    order = ["day", *cluster]
    return (df.withColumn("day", F.to_date(day)).repartitionByRange(*order, F.xxhash64(*df.columns))
            .sortWithinPartitions(*order))


def write_table(df: DataFrame, table: str, path: str, mode: str = "overwrite") -> None:
    writer = laid_out(df, table).write.mode(mode)
    if LAYOUT[table][0]:
        writer = writer.partitionBy("day")
    writer.parquet(path)


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    schema = schemas.TABLES[table]
    if LAYOUT[table][0]:
        schema = schemas.with_columns(schema, day="date")
    return spark.read.schema(schema).parquet(path)


def between_days(df: DataFrame, table: str, first: date, last: date) -> DataFrame:
    """Rows of the days first to last. Filters the partition column, so other days are not read."""
    return df.filter(F.col("day").between(F.lit(first), F.lit(last)))


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Drop and create the six empty tables with layout, description and labels."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for table, schema in schemas.TABLES.items():
        day, cluster = LAYOUT[table]
        description, domain, personal = LABELS[table]
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
        labels = {"domain": domain, "clustered_by": ",".join(cluster)}
        if personal:
            labels["pii"] = "true"
        properties = ", ".join(f"'{k}'='{v}'" for k, v in labels.items() if v)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
        spark.sql(
            f"CREATE TABLE {database}.{table} ({', '.join(columns + ['day date'] * bool(day))}) "
            f"USING parquet {'PARTITIONED BY (day) ' if day else ''}"
            f"LOCATION '{location}/{table}' COMMENT '{description}' TBLPROPERTIES ({properties})")


def load_table(spark: SparkSession, database: str, table: str, df: DataFrame) -> None:
    """Replace a created table's rows."""
    rows = schemas.conform(df, schemas.TABLES[table])
    laid_out(rows, table).write.mode("overwrite").insertInto(f"{database}.{table}")


# Replacing a table at once ---------------------------------------------------------------------

def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v*'").collect()
    return sorted((r.tableName for r in found), key=lambda name: int(name.rsplit("__v", 1)[1]))


def replace_table(spark: SparkSession, database: str, location: str, table: str, df: DataFrame) -> None:
    """Replace a table's rows so that readers of its name see the old rows or the new ones.

    The name is a view of a version with files of its own. The new version is written whole, and then
    one change of the catalogue, the view's definition, makes it the table. A load that fails leaves
    the view, and so the old rows, as they are. The version before stays for queries that are running;
    older ones and those of failed loads are dropped by the next load.
    """
    rows = schemas.conform(df, schemas.TABLES[table])
    description, domain, personal = LABELS[table]
    before = _versions(spark, database, table)
    number = int(before[-1].rsplit("__v", 1)[1]) + 1 if before else 0
    name = f"{table}__v{number}"
    writer = laid_out(rows, table).write.option("path", f"{location}/{name}").format("parquet")
    (writer.partitionBy("day") if LAYOUT[table][0] else writer).saveAsTable(f"{database}.{name}")
    columns = ", ".join([*schemas.TABLES[table].fieldNames(), *["day"] * bool(LAYOUT[table][0])])
    labels = f"'domain'='{domain}', 'version'='{name}'" + (", 'pii'='true'" if personal else "")
    # The version in use, which a failed load may have left behind younger ones.
    used = [v for v in before if spark.catalog.tableExists(f"{database}.{table}")
            and v == spark.sql(f"SHOW TBLPROPERTIES {database}.{table}('version')").first()["value"]]
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} COMMENT '{description}' TBLPROPERTIES ({labels}) "
              f"AS SELECT {columns} FROM {database}.{name}")
    for old in before:
        if old not in used:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
            _delete(spark, f"{location}/{old}")


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
