"""Equi-join of rows with per-key values when a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SLICES = 8
# Rows with a NULL key match nothing, so a left join may spread them as widely as it likes.
_NULL_SLICES = 1 << 16


def join_per_key(rows: DataFrame, values: DataFrame, key: str | list[str], how: str = "inner",
                 slices: int = SLICES, deal_by: list[str] | None = None) -> DataFrame:
    """Join ``rows`` to ``values``, which has one row per key and is the result of an aggregation.

    Adaptive execution splits a hot key only where both join inputs come straight from a shuffle,
    and aggregated ``values`` do not. So every key's rows are dealt evenly over ``slices`` parts by
    a hash of ``deal_by`` (all columns unless given), and each value row is repeated for each part.
    No key is looked up beforehand, and a retried task deals as before. A hot key fills ``slices``
    tasks; 1 makes it a plain join. Keep ``values`` narrow, as it is repeated ``slices`` times.
    The repeated values are merged, never broadcast: Spark's estimate knows neither their repeats nor
    how well their files are packed. ``how`` is inner or left.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how == "inner":
        rows = rows.dropna(subset=keys)
    if slices <= 1:
        return rows.join(values, keys, how)
    part = F.xxhash64(*(deal_by or rows.columns))
    empty = F.greatest(*(F.col(k).isNull() for k in keys)) if len(keys) > 1 else F.col(keys[0]).isNull()
    dealt = rows.withColumn("_slice", F.when(empty, F.pmod(part, F.lit(_NULL_SLICES)))
                            .otherwise(F.pmod(part, F.lit(slices))).cast("int"))
    repeated = values.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return dealt.join(repeated.hint("merge"), [*keys, "_slice"], how).drop("_slice")
