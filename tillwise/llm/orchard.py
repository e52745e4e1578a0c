"""Vector codes whose entries are found by Orchard's search.

Vectors become integers and are cut into equal parts; each part position has a codebook of entries,
refined by rounds of assigning every part to its nearest entry and moving each entry to the mean of
its parts. All arithmetic is on integers, so the codes are the same in any layout and order of rows.

The nearest entry is found by Orchard's method: every entry has a list of all entries sorted by their
distance from it. A search walks the list of the best entry so far, jumps to the list of an entry
that is nearer, marks what it has visited, and ends where the list is beyond twice the current
distance: whatever follows is farther than the best entry, by the triangle inequality. Many searches
walk at once: those that stand in the same list at the same place look at its next entries together.

A round is one pass: each task adds up its parts per entry, Spark adds the sums of all tasks, and
entries times dimensions numbers come to the driver, whatever the number of vectors. The codebooks of
the next round travel with the tasks, and are as small.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
those of another length than most or of one that does not split into ``PARTS``; with equal numbers
the greater length counts. The first entries are the parts of the vectors of the smallest ids; of
vectors with the same id the least by components, and those without an id as one, last. With fewer
ids there are fewer entries. Repeated rows are coded one by one; an empty table gives no rows.
Components are bounded by what squared distances in 64 bits hold (2^24 for 16 components in a
part); beyond that an OverflowError tells so. Very long vectors need 8 bytes per component and
row of a block of ``BLOCK`` components. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm import common
from tillwise.operators.skew import join_per_key

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Entries looked at in the first step into a list (each later one doubles what has been seen of it),
# and components and vectors searched at once.
STEP, BLOCK, ROWS = 64, 1 << 22, 1 << 16

ASSIGNED = "vec_id long, label long, code string, error long"


class Codebook:
    """The entries of one part position with their sorted neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        k, n = self.entries.shape
        kind = self._kind(self.entries)
        between = self._squares(kind, self.entries.astype(kind), np.arange(k))
        # Lists in order of distance, ties by index.
        self.order = np.argsort(between, axis=1, kind="stable")
        self.apart = np.take_along_axis(between, self.order, axis=1)
        # Searches begin at the nearest of a few entries spread over the codebook.
        self.gates = np.arange(0, k, max(1, int(k ** 0.5)))

    def _kind(self, points: np.ndarray):
        """Doubles where distance times entries stays below 2^53, so that they hold it exactly; else
        64-bit integers."""
        k, n = self.entries.shape
        size = max(abs(int(f(initial=0))) for x in (points, self.entries) for f in (x.min, x.max))
        most = 4 * size * size * n * k
        if most >= 1 << 63:
            raise OverflowError(f"components of up to {size} have distances beyond 64 bits")
        return np.float64 if most < 1 << 53 else np.int64

    def _squares(self, kind, points: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Squared distances of points to the chosen entries."""
        e = self.entries[chosen].astype(kind)
        return (points * points).sum(axis=1)[:, None] - 2 * (points @ e.T) + (e * e).sum(axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry; ties go to the lower index."""
        m, k = len(points), len(self.entries)
        kind = self._kind(points)
        points = points.astype(kind)
        # One number orders by distance, then by index.
        best = (self._squares(kind, points, self.gates) * k + self.gates).min(axis=1)
        visited = np.zeros((m, k), bool)
        visited[:, self.gates] = True
        at, active = np.zeros(m, np.int64), np.arange(m)
        while active.size:
            # Those at the same place of the same list go together.
            place = (best[active] % k).astype(np.int64) * k + at[active]
            order = np.argsort(place, kind="stable")
            active, place = active[order], place[order]
            edges = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            for members, here in zip(np.split(active, edges[1:]), place[edges]):
                self._step(kind, points, members, int(here) // k, int(here) % k, best, visited.ravel(), at)
            # A list ends, or lies beyond twice the distance, which is four times its square.
            active = active[at[active] < k]
            beyond = (self.apart[(best[active] % k).astype(np.int64), at[active]]
                      > 4 * (best[active] // k))
            active = active[~beyond]
        return (best % k).astype(np.int64), (best // k).astype(np.int64)

    def _step(self, kind, points, members, entry, start, best, visited, at) -> None:
        """Look at the next entries of one list for all members that stand there."""
        k = len(self.entries)
        chosen = self.order[entry, start:start + max(STEP, start)]
        cells = members[:, None] * k + chosen
        at[members] = start + len(chosen)
        seen = visited[cells]
        if seen.all():
            return
        visited[cells] = True
        before = best[members]
        found = self._squares(kind, points[members], chosen) * k + chosen
        found = np.where(seen, before[:, None], found).min(axis=1)
        best[members] = np.minimum(found, before)
        at[members[found < before]] = 0  # jump: the improved entry's list, from its start


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part, with integer components, before the length is
    looked at."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.coalesce(finite, F.lit(False)) & (F.size(x) > 0) & (F.size(x) % PARTS == 0))
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    F.transform(x, lambda c: F.floor(c * SCALE)).alias("v")))


def first_entries(rows: DataFrame, dimensions: int, entries: int = ENTRIES) -> list[np.ndarray]:
    """One array (entries, components) per part position, from the smallest ids."""
    chosen = (rows.groupBy("vec_id").agg(F.min("v").alias("v"))
              .orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect())
    whole = np.array([r.v for r in chosen], np.int64).reshape(-1, dimensions)
    return np.split(whole, PARTS, axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches put together to blocks of about ``BLOCK`` components, with the vectors as a matrix."""
    held, rows, most = [], 0, max(1, min(ROWS, BLOCK // dimensions))
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= most:
            yield _matrix(held, dimensions)
            held, rows = [], 0
    if held:
        yield _matrix(held, dimensions)


def _matrix(held: list[pa.RecordBatch], dimensions: int) -> tuple[pa.Table, np.ndarray]:
    block = pa.Table.from_batches(held)
    flat = np.concatenate([c.flatten().to_numpy() for c in block["v"].chunks])
    return block, flat.reshape(-1, dimensions)


def _sums(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Codebook(b) for b in books]
        k, width = books[0].shape
        sums, counts = np.zeros((PARTS, k, width), np.int64), np.zeros((PARTS, k), np.int64)
        for _, vectors in _blocks(batches, PARTS * width):
            for p, points in enumerate(np.split(vectors, PARTS, axis=1)):
                found, _ = searched[p].nearest(points)
                order = np.argsort(found, kind="stable")
                starts = np.flatnonzero(np.diff(found[order], prepend=-1))
                sums[p][found[order][starts]] += np.add.reduceat(points[order], starts, axis=0)
                counts[p] += np.bincount(found, minlength=k)
        p, entry = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(p, width).astype(np.int32)), pa.array(np.repeat(entry, width).astype(np.int32)),
                 pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))),
                 pa.array(sums[p, entry].ravel()), pa.array(np.repeat(counts[p, entry], width))],
                names=["part", "entry", "i", "total", "n"])
    return run


def refine(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: entries become the floored mean of their parts; unused ones
    stay."""
    # One row per component of the codebooks reaches the driver.
    sums = (rows.select("v").mapInArrow(_sums(books), "part int, entry int, i int, total long, n long")
            .groupBy("part", "entry", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    moved = [b.copy() for b in books]
    for r in sums:
        moved[r.part][r.entry, r.i] = r.total // r.n
    return moved


def learn(rows: DataFrame, dimensions: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after all rounds."""
    books = first_entries(rows, dimensions, entries)
    for _ in range(rounds):
        books = refine(rows, books)
    return books


def _assigned(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [Codebook(b) for b in books]
        digits = np.array([f"{i:02x}" for i in range(len(books[0]))])
        for block, vectors in _blocks(batches, PARTS * books[0].shape[1]):
            error, code = np.zeros(len(vectors), np.int64), np.full(len(vectors), "", f"<U{2 * PARTS}")
            for p, points in enumerate(np.split(vectors, PARTS, axis=1)):
                found, distance = searched[p].nearest(points)
                error += distance
                code = np.char.add(code, digits[found])
            yield from pa.table({"vec_id": block["vec_id"], "label": block["label"], "code": pa.array(code.tolist()),
                                 "error": error}).to_batches(max_chunksize=65_536)
    return run


def assign(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    return rows.select("vec_id", "label", "v").mapInArrow(_assigned(books), ASSIGNED)


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
             ) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part."""
    rows = common.stored(usable(vectors, vec_id, embedding, label), "vectors")
    # The usual length: one row reaches the driver.
    usual = (rows.groupBy(F.size("v").alias("n")).count()
             .orderBy(F.desc("count"), F.desc("n")).first())
    if usual is None:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = rows.where(F.size("v") == usual.n)
    books = learn(rows, usual.n)
    # Rows without a label are a group like any other.
    named = F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("group")
    coded = common.stored(assign(rows, books).select("vec_id", "code", "error", named), "codes")
    errors = coded.groupBy("group").agg(F.sum("error").alias("label_error"))
    return join_per_key(coded, errors, "group").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
