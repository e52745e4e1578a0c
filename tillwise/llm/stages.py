"""The pipeline's stages: what each operator decides, carried out on the documents.

Each takes (spark, docs, sf_dir) and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import scratch
from tillwise.llm import common, minhash, mixing as mixes, neighbours, packing as packs, secrets as secret
from tillwise.operators.skew import join_per_key

# Words of a shingle in the near-duplicate stage.
WIDTH = 5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _ddl(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours' vote is below ``neighbours.KEEP`` go; decided in the scoring pass
    itself, so texts are not shuffled."""
    common.prepare(spark)
    docs = _columns(docs)
    space = neighbours.learn(docs, neighbours.training_labels(common.table(spark, sf_dir, "labels")))
    scored = docs.mapInArrow(neighbours.with_score(space), f"{_ddl(docs)}, score double")
    return _columns(scored.where(F.col("score") >= neighbours.KEEP))


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents, each row with a number of its own and a hash of all its columns. Written once,
    so all that reads them sees the same numbers, also after lost executors."""
    return common.stored(_columns(docs).withColumns({
        "_tie": F.xxhash64(*COLUMNS), "_row": F.monotonically_increasing_id()}), "rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one of the smallest doc_id (null last).
    Every row is judged by its own text, whatever rows share its id or lack one; texts without words
    are nobody's copy and stay. No rows give no rows; very long texts are compared whole."""
    common.prepare(spark)
    rows = _numbered(docs)
    groups = common.stored(minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), WIDTH)
                           .select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "groups")
    # Numbers follow the layout of the files; the row that stays does not.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_tie", "_row")
    first = (groups.join(rows.select("_row", "doc_id", "_tie"), "_row").groupBy("_group")
             .agg(F.min(order).alias("x"), F.count("*").alias("n")).where("n > 1")
             .select("_group", F.col("x._row").alias("_first")))
    gone = join_per_key(groups, first, "_group").where("_row <> _first").select("_row")
    return _columns(rows.join(gone, "_row", "left_anti"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which any rule finds a secret go; rows without an id are judged too."""
    common.prepare(spark)
    docs = _columns(docs).withColumn("_blob", F.sha2(F.coalesce("text", F.lit("")), 256))
    ledger = scratch.new_folder(spark, "ledger")
    secret.scan(docs, "doc_id", "text", ledger)
    bad = secret.read_ledger(spark, ledger).where(F.size("spans") > 0).select(
        F.col("blob").alias("_blob")).distinct()
    return _columns(docs.join(bad, "_blob", "left_anti"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; one that it does not take goes, so do rows without
    words. Rows that share an id, or have none, are taken one by one. No rows give no rows."""
    common.prepare(spark)
    rows = _numbered(docs)
    takes = mixes.mix(rows, "_tie", "_row").where("taken > 0").select(
        "_row", (F.col("taken") / F.col("size")).cast("int").alias("_times"))
    chosen = rows.join(takes.hint("merge"), "_row")
    return _columns(chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    common.prepare(spark)
    return packs.pack(docs, public_tokenizers.path(packs.TOKENIZER))
