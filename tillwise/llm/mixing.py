"""Mix sources to target weights by fitting each source's budget to its documents' lengths.

Sources in code-point order (null last) weigh 3, 1, 2, repeating, and share ``SHARE`` of all words.
A target above ``MOST`` times its source's size stops there, and the excess is shared anew by
weight. A source is taken whole as often as its target allows; for the rest of the budget documents
are counted by exact length, most of the budget is spread over the lengths in proportion, and the
remaining words (``REMAINDER`` and a length at most) are fitted by a bounded-knapsack program over
the counts that are left. So many documents of each length are then taken in the order of a seeded
hash. Lengths and targets use every document; only one row per source and distinct length meets in
one task.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source;
repeated rows are documents of their own; an empty table gives no rows; a source without words has
target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.llm import common

SHARE, MOST = 1.5, 2
WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
SEED = 97
# Documents of one source and length are cut into so many parts by their hash, so none is one task.
PARTS = 256
REMAINDER = 16_384


def key(source: str) -> Column:
    """A source's key, never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def sized(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, its key (never null) and size in words, with other columns as they are."""
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD))
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        key(source).alias("key"),
        words.cast("long").alias("size"), *also)


def targets(sizes: DataFrame) -> DataFrame:
    """key, source_size and target of every source; one row per source meets in the windows.

    Sources are put in the order in which they reach their limit as the share per weight grows;
    the first that does not reach it, with all before it at theirs, fixes that share.
    """
    totals = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    limit = (F.col("source_size") * MOST).cast("double")
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = ((F.sum("source_size").over(everything) * SHARE
              - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    found = (totals.withColumn("place", place).withColumn("weight", weight)
             .withColumn("limit", limit).withColumn("share", share)
             .withColumn("at", F.row_number().over(by_limit)))
    first = F.min(F.when(F.col("share") * F.col("weight") <= F.col("limit"),
                         F.struct("at", "share"))).over(everything)
    return found.select("key", "source_size", F.least(
        "limit", F.coalesce(F.col("weight") * first["share"], F.col("limit"))).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to ``budget``, or as
    near to it as the documents allow."""
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    # In proportion, longest first; what a length leaves over is carried to the next.
    spread, carry = max(0, budget - REMAINDER), 0.0
    for i in np.argsort(-lengths, kind="stable"):
        carry += counts[i] * lengths[i] * (spread / total)
        taken[i] = min(counts[i], int(carry // lengths[i]))
        carry -= int(taken[i] * lengths[i])
    left = budget - int((taken * lengths).sum())
    return taken + _knapsack(lengths, counts - taken, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts whose sum is nearest to ``budget``: reachable sums are the bits of an integer, and
    each length adds its powers of two of documents. Stops once the budget itself is reached."""
    top = 2 * budget + 1  # sums further off than none at all are of no use
    whole = (1 << (top + 1)) - 1
    reach, steps, states = 1, [], [1]
    for i in np.argsort(-lengths, kind="stable"):
        length, n, power = int(lengths[i]), int(min(counts[i], top // max(1, lengths[i]))), 1
        while n > 0 and length <= top and not reach >> budget & 1:
            k = min(power, n)
            reach |= (reach << (length * k)) & whole
            steps.append((i, k))
            states.append(reach)
            n, power = n - k, power * 2
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> budget
    over = budget + (above & -above).bit_length() - 1 if above else None
    at = over if over is not None and over - budget < budget - below else below
    out = np.zeros(len(lengths), np.int64)
    for (i, k), before in zip(reversed(steps), reversed(states[:-1])):
        if not before >> at & 1:
            out[i] += k
            at -= int(lengths[i]) * k
    return out


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", ignore_index=True)
    total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    whole = min(MOST, int(target // total)) if total else 0
    some = rows["size"].to_numpy() > 0
    extra = np.zeros(len(rows), np.int64)
    if whole < MOST:
        extra[some] = fit(rows["size"].to_numpy()[some], rows["n"].to_numpy()[some],
                          round(target - whole * total))
    return rows.assign(whole=whole, extra=extra)[["key", "size", "source_size", "target", "whole", "extra"]]


def mix(documents: DataFrame, tie: str | None = None, row: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, key for every row; taken counts repeats.

    Rows are drawn by their ids. Where ids may be shared or missing, ``tie`` names a column that
    tells rows apart by what they hold, and ``row`` one that tells all apart; both are returned."""
    ids = ["doc_id", tie] if tie else ["doc_id"]
    also = tuple(c for c in (tie, row) if c)
    sizes = common.stored(sized(documents, also=also), "sizes")
    part = F.pmod(F.xxhash64(F.lit(SEED), *ids), F.lit(PARTS)).cast("int")
    cells = sizes.groupBy("key", "size", part.alias("part")).agg(F.count("*").alias("n"))
    cells = common.stored(cells, "cells")
    per_length = (cells.groupBy("key", "size").agg(F.sum("n").alias("n"))
                  .join(targets(sizes), "key").groupBy("key").applyInPandas(
        _fit_source, "key string, size long, source_size long, target double, whole int, extra long"))
    earlier = Window.partitionBy("key", "size").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    quota = (cells.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .join(per_length, ["key", "size"])
             .select("key", "size", "part", "source_size", "target", "whole",
                     (F.col("extra") - F.col("earlier")).alias("quota")))
    own = Window.partitionBy("key", "size", "part").orderBy(F.xxhash64(F.lit(SEED + 1), *ids), "doc_id", *also)
    times = F.col("whole") + (F.row_number().over(own) <= F.col("quota")).cast("int")
    return (sizes.withColumn("part", part).join(quota, ["key", "size", "part"])
            .withColumn("taken", F.col("size") * times)
            .select("doc_id", "size", "source_size", "target", "taken", "key", *also))
