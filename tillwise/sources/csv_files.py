"""CSV files of the shop tables: write, typed load, load with rejects, load by position."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BAD = "_corrupt_record"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside a cell are doubled, NULL is nothing, empty text is quoted,
    white space at the ends of a cell stays, and times keep their microseconds."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path))


def _reader(spark: SparkSession, schema: StructType, quoted_newlines: bool):
    # Files whose cells may hold line breaks cannot be split here: each is read by one task.
    # ``load_csv_split`` splits them; or switch quoted_newlines off where no cell holds one.
    # NULL is marked by a character no text holds, or quoted empty cells would be NULL as well.
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("nullValue", "\0").option("multiLine", quoted_newlines))


def _texts(spark: SparkSession, names: list[str], path: str, quoted_newlines: bool) -> DataFrame:
    """All cells as text; rows of another width carry their own text in addition."""
    schema = StructType([StructField(name, StringType()) for name in [*names, _BAD]])
    # Without pruning: a short row would fit whenever only its first columns are asked for.
    return (_reader(spark, schema, quoted_newlines).option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _BAD).csv(path))


def load_csv(spark: SparkSession, schema: StructType, path: str,
             quoted_newlines: bool = True) -> DataFrame:
    """Typed load; reading a cell that does not fit the schema fails the job."""
    return _reader(spark, schema, quoted_newlines).option("mode", "FAILFAST").csv(path)


def load_text(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """Every cell as text, under the names in the header."""
    return (spark.read.option("header", True).option("escape", '"').option("nullValue", "\0")
            .option("multiLine", quoted_newlines).csv(path))


def load_csv_with_rejects(spark: SparkSession, schema: StructType, path: str,
                          quoted_newlines: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the text of those that do not.

    Cells are cast here and not by the reader, whose verdict on a row depends on the columns a
    query happens to use.
    """
    rows = _texts(spark, schema.fieldNames(), path, quoted_newlines)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    wrong_cell = reduce(or_, (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
                              for f in schema.fields))
    reason = F.when(F.col(_BAD).isNotNull(), "bad_width").when(wrong_cell, "bad_value")
    text = F.coalesce(F.col(_BAD), F.to_csv(F.struct(*schema.fieldNames()), {"escape": '"'}))
    return (rows.filter(reason.isNull()).select(*typed),
            rows.filter(reason.isNotNull()).select(text.alias("value"), reason.alias("reason")))


def load_by_position(spark: SparkSession, path: str, names: list[str],
                     width: int) -> tuple[DataFrame, DataFrame]:
    """The first columns of a CSV by position, under new names, whatever its header says.

    ``width`` is the number of columns the file should have. A row too short to fill all names is
    a reject; rows of another wrong width are kept, as only the first columns matter.
    """
    fields = names + [f"_rest{i}" for i in range(width - len(names))]
    rows = _texts(spark, fields, path, quoted_newlines=False)
    short = F.col(_BAD).isNotNull() & F.col(names[-1]).isNull()
    return (rows.filter(~short).select(*names),
            rows.filter(short).select(F.col(_BAD).alias("value"), F.lit("short_row").alias("reason")))


# One large file with line breaks in cells ------------------------------------------------------

def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value): the records of CSV files whose quoted cells may hold line breaks, each file
    read by as many tasks as it has splits.

    Every line knows the split it was read in, which begins at a byte of its file. A line break is
    inside a cell when the quotes before it are odd in number, doubled ones being two. So quotes are
    counted per split, the counts of the splits before tell how a split begins, and within a split a
    running count tells which lines begin a record. Lines of a record are joined within the split;
    only a split's first and last piece can belong to a record that goes on elsewhere, and these few
    are joined in order of their splits. Cells that hold quotes must be quoted, with quotes doubled.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    # One row per split.
    in_file = Window.partitionBy("file").orderBy("split")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "split").agg(F.sum("quotes").alias("n"))
              .select("file", "split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2).alias("open")))
    of_split = Window.partitionBy("file", "split").orderBy("line")
    before = of_split.rowsBetween(Window.unboundedPreceding, -1)
    upto = of_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotes = F.col("open") + F.coalesce(F.sum("quotes").over(before), F.lit(0))
    numbered = (lines.join(splits, ["file", "split"]).withColumn("begins", (quotes % 2 == 0).cast("int"))
                .withColumn("record", F.sum("begins").over(upto)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    # Piece 0 goes on with a record that began in a split before; the last one may go on in the next.
    pieces = (numbered.groupBy("file", "split", "record")
              .agg(text.alias("value"), F.min("line").alias("line"), F.sum("quotes").alias("quotes"))
              .withColumn("whole", (F.col("record") > 0) & (F.col("quotes") % 2 == 0)))
    ends = pieces.where("NOT whole").withColumn("chain", F.sum((F.col("record") > 0).cast("int")).over(
        Window.partitionBy("file").orderBy("split", "record").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "record", "value"))), lambda x: x["value"]), "\n")
    chained = ends.groupBy("file", "chain").agg(joined.alias("value"), F.min(F.struct("split", "record")).alias("at"))
    return (pieces.where("whole").select("file", F.struct("split", "record").alias("at"), "value")
            .unionByName(chained.select("file", "at", "value")).withColumn("value", F.regexp_replace("value", "\r$", "")))


def load_csv_split(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """``load_csv`` of files too large for one task each. Every record is read by Spark's own parser;
    one that does not fit the schema fails the job."""
    found = records(spark, path)
    header = (F.col("at.split") == 0) & (F.col("at.record") == 1)
    options = {"escape": '"', "nullValue": "\0", "multiLine": "true", "mode": "FAILFAST"}
    row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), options)
    return found.where(~header & (F.col("value") != "")).select(row.alias("row")).select("row.*")
