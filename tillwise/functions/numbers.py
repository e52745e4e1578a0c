"""Sums, averages, shares and rounding whose results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x: Column | str, weight: Column | None = None, scale: int = 4) -> Column:
    """Sum of a double column; for amounts of up to ``scale`` decimals it does not depend on the
    order in which rows are added.

    Each value is its whole units of the last decimal place and a rest. Units are added up as two
    32-bit halves in 64-bit integers, so they do not overflow; the rest, which is zero for such
    amounts, is added as doubles, so finer values, NaN, infinity and values too large for units
    lose nothing. ``weight`` counts each row that many times.
    """
    x = _col(x)
    power, half = float(10 ** scale), 1 << 32
    units = F.coalesce(F.rint(x * power).try_cast("bigint"), F.lit(0).cast("bigint"))
    high, low, rest = F.shiftright(units, 32), units.bitwiseAND(F.lit(half - 1)), x - units / power
    if weight is not None:
        high, low, rest = high * weight, low * weight, rest * weight
    whole = F.sum(high).cast("decimal(20,0)") * F.lit(half).cast("decimal(10,0)") + F.sum(low)
    return F.when(F.count(x) > 0, whole.cast("double") / power + F.sum(rest))


def unit_parts(x: Column | str, scale: int = 4) -> tuple[Column, Column, Column]:
    """The sum of ``exact_sum`` in parts that can be added up later: ``units``, ``rest`` and the
    number of ``amounts``. Sums of sums stay exact, which sums of doubles would not."""
    x = _col(x)
    power = float(10 ** scale)
    units = F.coalesce(F.rint(x * power).try_cast("bigint"), F.lit(0).cast("bigint"))
    return (F.sum(units.cast("decimal(19,0)")).cast("decimal(38,0)").alias("units"),
            F.coalesce(F.sum(x - units / power), F.lit(0.0)).alias("rest"), F.count(x).alias("amounts"))


def merged_units() -> tuple[Column, Column, Column]:
    """Aggregates that add up parts."""
    return (F.sum("units").cast("decimal(38,0)").alias("units"), F.sum("rest").alias("rest"),
            F.sum("amounts").alias("amounts"))


def units_value(scale: int = 4) -> Column:
    """The sum that parts stand for; NULL without amounts."""
    return F.when(F.col("amounts") > 0, F.col("units").cast("double") / float(10 ** scale) + F.col("rest"))


def mean(x: Column | str, weight: Column | None = None, scale: int = 4) -> Column:
    """Average over the non-null values; NULL when there are none."""
    x = _col(x)
    n = F.count(x) if weight is None else F.sum(F.when(x.isNotNull(), weight))
    return F.try_divide(exact_sum(x, weight, scale), n)


def share(condition: Column) -> Column:
    """Part of the group's rows for which the condition is true (NULL counts as not true);
    NULL without rows."""
    return F.try_divide(F.count_if(condition), F.count("*"))


def round_to(x: Column | str, places: int) -> Column:
    """Round half away from zero, judged on the scaled double; NaN and infinity pass."""
    power = float(10 ** places)
    return F.round(_col(x) * power) / power
