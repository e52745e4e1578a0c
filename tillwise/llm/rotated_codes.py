"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are taken relative to their mean, padded to ``BITS`` dimensions, turned by a seeded random
rotation and kept as one sign bit per turned dimension, with two scalars: the length, and the inner
product of the unit vector with its own code. A query's inner product with a vector is estimated from
the packed bits and the scalars; the error of such an estimate is bounded, by ``SURE`` standard
deviations of the rotation's choice, and falls with the root of the number of bits. The result is
that of brute force unless a bound fails, which at SURE = 4 happens to less than one in ten thousand.

Equal vectors are one class with its ``k + 1`` smallest ids, more of which no result can hold, so a
vector that a third of all rows share is compared once. Queries and codes are dealt into blocks by a
hash and every block of queries meets every block of codes, twice: first each query's nearest classes
by estimate are compared exactly, and the distance of the (k+1)-th of their rows is its limit; then
the classes whose bound is within the limit are its candidates. Blocks hold codes and scalars only.
Whole vectors travel for candidates alone, which are compared exactly and ranked per query.

Defined results: vectors that are null, of another length than most, zero, or hold null or
non-finite components take no part, as queries or candidates; rows without vec_id neither. A query's
own row is left out; repeated rows (same id and vector) count once; rows of one id with different
vectors are different rows, searched one by one and ranked together; fewer than ``k`` candidates are
all returned; without vectors there are no rows. Columns of other names pass unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.llm import common
from tillwise.operators.skew import join_per_key

SURE, SEED = 4.0, 71
# A code's bits at least: shorter vectors are padded.
BITS = 1024
QUERY_BLOCK, CODE_BLOCK = 16_384, 16_384
# Queries and codes whose estimates are held at a time.
_QUERIES, _CODES = 1024, 2048
MARKS = ("mark", "mark_2")
# Estimates are added in single precision.
_ROUNDING = 1e-5


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """Orthonormal rows, the same for a seed: a random rotation of padded vectors, without the rows
    that only meet padding."""
    bits = -(-max(BITS, dimensions) // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dimensions)))
    return (q * np.sign(np.diag(r))).T


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of the unit vectors with their codes."""
    d = vectors - centre
    length = np.linalg.norm(d, axis=1)
    unit = np.divide(d, length[:, None], out=np.zeros_like(d), where=length[:, None] > 0) @ turn
    bits = unit > 0
    own = np.abs(unit).sum(axis=1) / np.sqrt(turn.shape[1])
    return np.packbits(bits, axis=1), length, own


def bounds(query: np.ndarray, bits: np.ndarray, length: np.ndarray, own: np.ndarray,
           centre: np.ndarray, turn: np.ndarray, sure: float = SURE) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances and the least they can be, of queries to encoded vectors."""
    n = turn.shape[1]
    d = query - centre
    size = np.linalg.norm(d, axis=1)
    signs = np.unpackbits(bits, axis=1, count=n).astype(np.float32) * 2 - 1
    raw = (d @ turn).astype(np.float32) @ signs.T / np.sqrt(n)  # inner product of the query with the code itself
    safe = np.where(own > 0, own, 1)
    inner = raw / safe
    spread = np.sqrt(np.clip(1 - safe ** 2, 0, None)) / safe * sure / np.sqrt(n - 1) + _ROUNDING
    base = size[:, None] ** 2 + length ** 2
    return base - 2 * length * inner, base - 2 * length * (inner + size[:, None] * spread)


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)


def _compared(queries: pa.Table, codes: pa.Table, centre: np.ndarray, turn: np.ndarray
              ) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
    """Part by part of a block: which queries and codes, their estimates and least distances."""
    if not len(queries) or not len(codes):
        return
    q = _matrix(queries["v"], len(centre))
    bits = np.frombuffer(b"".join(codes["bits"].to_pylist()), np.uint8).reshape(len(codes), -1)
    length, own = codes["length"].to_numpy(), codes["own"].to_numpy()
    for a in range(0, len(codes), _CODES):
        c = slice(a, a + _CODES)
        for b in range(0, len(queries), _QUERIES):
            part = slice(b, b + _QUERIES)
            yield part, c, *bounds(q[part], bits[c], length[c], own[c], centre, turn)


def _nearest(centre: np.ndarray, turn: np.ndarray, most: int):
    """For each query the ``most`` nearest codes by estimate, of each part of a block."""
    def run(queries: pa.Table, codes: pa.Table) -> pa.Table:
        rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for part, c, guess, _ in _compared(queries, codes, centre, turn):
            n = min(most, guess.shape[1])
            at = np.argpartition(guess, n - 1, axis=1)[:, :n]
            rows.append((np.repeat(queries["q_class"].to_numpy()[part], n), codes["class"].to_numpy()[c][at].ravel(),
                         np.take_along_axis(guess, at, 1).ravel()))
        return pa.table(dict(zip(("q_class", "class", "guess"), map(np.concatenate, zip(*rows)))))
    return run


def _within(centre: np.ndarray, turn: np.ndarray):
    """The codes whose least distance is within the query's limit; all, if it has none."""
    def run(queries: pa.Table, codes: pa.Table) -> pa.Table:
        rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        limit = queries["limit"].to_numpy() ** 2 * (1 + 1e-9) + 1e-12
        for part, c, _, least in _compared(queries, codes, centre, turn):
            i, j = np.nonzero(least <= limit[part][:, None])
            rows.append((queries["q_class"].to_numpy()[part][i], codes["class"].to_numpy()[c][j]))
        return pa.table(dict(zip(("q_class", "class"), map(np.concatenate, zip(*rows)))))
    return run


def _distances(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _matrix(batch.column("v"), n) - _matrix(batch.column("q"), n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("q_class", "class", "ids")), pa.array(np.sqrt((d ** 2).sum(axis=1)))],
                names=["q_class", "class", "ids", "score"])
    return run


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Distinct (vec_id, v) that take part."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"),
                           F.coalesce(finite & some, F.lit(False)).alias("_good"))
            .where("_good AND vec_id IS NOT NULL").select("vec_id", "v").distinct())


def _sums(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(n), 0
        for batch in batches:
            total += _matrix(batch.column(0), n).sum(axis=0)
            count += len(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n, dtype=np.int32)), pa.array(total), pa.array(np.full(n, count))],
            names=["i", "total", "n"])
    return run


def _encoded(centre: np.ndarray):
    turn = rotation(len(centre))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, length, own = encode(_matrix(batch.column(1), len(centre)), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length),
                 pa.array(own)], names=["class", "bits", "length", "own"])
    return run


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """(class, *MARKS, v, ids): the distinct vectors of (vec_id, v, *MARKS), each with its ``most``
    smallest ids."""
    own = Window.partitionBy(*MARKS).orderBy("vec_id")
    few = rows.withColumn("at", F.row_number().over(own)).where(F.col("at") <= most)
    return few.groupBy(*MARKS).agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("class"), *MARKS, "v", "ids")


def marked(rows: DataFrame) -> DataFrame:
    """With a 128-bit hash of the vector, by which equal vectors are told."""
    return rows.withColumns({MARKS[0]: F.xxhash64("v"), MARKS[1]: F.xxhash64(F.lit(SEED), "v")})


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest other vectors. ``is_query`` is a
    condition on vec_id."""
    rows = common.stored(marked(usable(vectors)), "vectors")
    # The usual length; ties go to the longer. One row per length reaches the driver, at most one here.
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if usual is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = usual.n
    rows = rows.where(F.size("v") == n)
    classes = common.stored(classes_of(rows, k + 1), "classes")
    queries = common.stored(
        join_per_key(rows.where(is_query).select("vec_id", *MARKS), classes.select(*MARKS, "class"), list(MARKS),
                     deal_by=["vec_id"])
        .select(F.col("vec_id").alias("query_id"), "class"), "queries")
    asked = common.stored(queries.select("class").distinct().join(classes, "class").select(
        F.col("class").alias("q_class"), "v"), "asked")
    # The mean of all vectors: sums per task, then one row per dimension.
    means = (classes.select("v").mapInArrow(_sums(n), "i int, total double, n long")
             .groupBy("i").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("i").collect())
    centre = np.array([r["mean"] for r in means])
    index = common.stored(classes.select("class", "v").mapInArrow(
        _encoded(centre), "class long, bits binary, length double, own double"), "codes")
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-index.count() // CODE_BLOCK))
    turn = rotation(n)

    def dealt(chosen: DataFrame, key: str, own: str, mine: int, other: str, theirs: int) -> DataFrame:
        return chosen.withColumn(own, F.pmod(F.xxhash64(key), F.lit(mine)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(theirs - 1))))

    def met(queries: DataFrame, run, schema: str) -> DataFrame:
        q = dealt(queries, "q_class", "q_block", q_blocks, "c_block", c_blocks)
        c = dealt(index, "class", "c_block", c_blocks, "q_block", q_blocks)
        return q.groupBy("q_block", "c_block").cogroup(c.groupBy("q_block", "c_block")).applyInArrow(run, schema)

    def exact(pairs: DataFrame) -> DataFrame:
        both = pairs.select("q_class", "class").join(classes.select("class", "v", "ids"), "class").join(
            asked.withColumnRenamed("v", "q"), "q_class")
        return both.select("q_class", "class", "ids", "v", "q").mapInArrow(
            _distances(n), "q_class long, class long, ids array<long>, score double")

    near = met(asked, _nearest(centre, turn, k + 1), "q_class long, class long, guess double")
    by_guess = Window.partitionBy("q_class").orderBy("guess", "class")
    near = common.stored(near.withColumn("at", F.row_number().over(by_guess)).where(F.col("at") <= k + 1), "near")
    by_score = Window.partitionBy("q_class").orderBy("score", "class")
    limits = (exact(near).withColumn("rows", F.sum(F.size("ids")).over(by_score))
              .groupBy("q_class").agg(F.min(F.when(F.col("rows") > k, F.col("score"))).alias("limit")))
    limited = asked.join(limits, "q_class", "left").withColumn(
        "limit", F.coalesce("limit", F.lit(float("inf"))))
    candidates = common.stored(met(limited, _within(centre, turn), "q_class long, class long"), "candidates")
    # The k + 1 nearest rows of a class of queries, its own among them; each query then leaves itself out.
    by_row = Window.partitionBy("q_class").orderBy("score", "vec_id", "class")
    lists = (exact(candidates).select("q_class", "class", "score", F.explode("ids").alias("vec_id"))
             .withColumn("at", F.row_number().over(by_row)).where(F.col("at") <= k + 1)
             .groupBy(F.col("q_class").alias("class")).agg(F.collect_list(F.struct(
                 "score", "vec_id", F.col("class").alias("of"))).alias("near")))
    lists = common.stored(lists, "lists")
    found = (join_per_key(queries, lists, "class", deal_by=["query_id"])
             .select("query_id", "class", F.explode("near").alias("x"))
             .where((F.col("x.vec_id") != F.col("query_id")) | (F.col("x.of") != F.col("class")))
             .select("query_id", "x.vec_id", "x.score"))
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
