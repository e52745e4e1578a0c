"""Rank within groups that may be too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.operators.skew import join_per_key

# A double's 64 bits in order of its value are a path of three steps; a window sees the children of one
# node, so at most 2^22 rows, whatever the table.
_LOW, _MIDDLE = 21, 42
_LAST = -(1 << 63)


def _ordered_bits(value: Column) -> Column:
    """A 64-bit integer that orders as the double does: NaN above infinity, NULL below all."""
    number = F.coalesce(value, F.lit(0.0)) + F.lit(0.0)  # the method takes no NULL; -0.0 is 0.0
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number).cast("bigint")
    return (F.when(value.isNull(), F.lit(_LAST)).when(bits >= 0, bits)
            .otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1))))


def rank_within(df: DataFrame, group: str, value: str, rank: str) -> DataFrame:
    """Add ``rank() OVER (PARTITION BY group ORDER BY value DESC)``, ties sharing a rank.

    Rows become distinct values with their number first, so any number of ties is one row. The values'
    bits make a tree of three levels; a node's rows are counted, and what lies above a value is a
    prefix sum among the children of each node on its way. So no task holds a group, and the result
    does not depend on how rows are laid out. Rows are joined to their value's rank at the end.
    """
    node = {"_none": F.col(group).isNull(), "_text": F.coalesce(F.col(group).cast("string"), F.lit(""))}
    keyed = df.withColumns({**node, "_key": _ordered_bits(F.col(value).cast("double"))})
    top, middle = F.shiftright("_key", _MIDDLE), F.shiftright("_key", _LOW).bitwiseAND(F.lit((1 << _LOW) - 1))
    names = list(node)
    values = (keyed.groupBy(*names, "_key").agg(F.count("*").alias("n"))
              .withColumns({"_top": top, "_middle": middle}))
    twigs = values.groupBy(*names, "_top", "_middle").agg(F.sum("n").alias("n"))
    limbs = twigs.groupBy(*names, "_top").agg(F.sum("n").alias("n"))

    def above(within: list[str], by: str) -> Column:
        before = Window.partitionBy(*within).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(before), F.lit(0))

    limbs = limbs.select(*names, "_top", above(names, "_top").alias("_above"))
    within = [*names, "_top"]
    twigs = (twigs.withColumn("_here", above(within, "_middle")).join(limbs, within)
             .select(*within, "_middle", (F.col("_above") + F.col("_here")).alias("_above")))
    within = [*within, "_middle"]
    ranked = (values.withColumn("_here", above(within, "_key")).join(twigs, within)
              .select(*names, "_key", (F.col("_above") + F.col("_here") + 1).alias("_rank")))
    return join_per_key(keyed, ranked, [*names, "_key"]).select(*df.columns, F.col("_rank").alias(rank))
