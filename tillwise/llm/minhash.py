"""Near-duplicate documents by MinHash bands, checked on whole shingle sets.

Words are [^\\x20\\x09-\\x0D]+ of the text with A-Z lowered; a document's set holds its distinct
runs of ``WIDTH`` words (another number may be asked for), or its whole word sequence if that is shorter. Two documents are linked if
100 * intersection >= 80 * union. The result is exact up to the chance that a pair at the threshold
shares no band, (1 - 0.8^ROWS)^BANDS, about 1e-7, and less for closer pairs.

1. One pass over the texts gives each document its set's size, a 128-bit key and band keys from the
   minima of universal hash functions. Documents of one key hold one set, so only the first of them
   goes on: thousands of copies are one node.
2. Each bucket of a band proposes ``HEADS`` of its members to the others, the first in as many orders;
   every document takes the first proposal of each order, and these pairs are checked on the whole sets.
   This joins the bulk of any large group, also where its members differ from any one of them.
3. Buckets that still hold several components compare the rows outside their largest component with
   all rows, block by block: first the signatures, then, for pairs that may reach the threshold, the
   whole sets. A task returns a forest: a link only where it joins components that the links before
   it left apart, so fewer links than it has rows. Pairs inside one component could change nothing
   and are not compared, so no link is lost, and no group is written out as pairs.
4. Components of all checked links by large-star and small-star.

Defined results: a null or empty text has an empty set and is linked with nothing; a row without
doc_id is linked with nothing and kept, its component_id null; rows that share a doc_id count as
one document that is linked as any of its texts is. Columns of other names pass unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillwise.llm import common
from tillwise.llm.components import components
from tillwise.operators.skew import join_per_key

WIDTH = 4
BANDS, ROWS = 40, 5
MINIMA = BANDS * ROWS
# Members that a bucket proposes to the others.
HEADS = 4
# Agreement of signature bytes that a pair of similarity 0.8 misses with a chance below 1e-7.
LEAST_AGREEMENT = 0.64
# Rows of a block; whole sets travel in it, so it is kept small.
LEFT_BLOCK, RIGHT_BLOCK = 256, 1024
# Shingles of one side that are compared at once.
AT_ONCE = 200_000

_draw = np.random.default_rng(20240611)
_A = (_draw.integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1))[:, None]
_B = _draw.integers(0, 1 << 32, MINIMA, np.uint32)[:, None]
_BAND = (_draw.integers(0, 1 << 63, (BANDS, ROWS + 1), np.uint64) << np.uint64(1)) | np.uint64(1)

SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = common.text_bytes(texts)
    h, rows = common.word_hashes(data, offsets, lower=True)
    counts = np.bincount(rows, minlength=len(texts))
    starts = np.concatenate(([0], np.cumsum(counts)))
    runs = common.windows(h, width)
    for i, n in enumerate(counts):
        at = starts[i]
        if n >= width:
            yield np.unique(runs[at:at + n - width + 1])
        elif n:
            yield common.windows(h[at:at + n], int(n))
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function a * x + b modulo 2^32 over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (_A * x[None, at:at + 1024] + _B).min(axis=1), out=least)
    return least


def _sketches(batches: Iterator[pa.RecordBatch], width: int = WIDTH) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    for batch in batches:
        sizes, k1, k2, bands = [], [], [], []
        for s in shingle_sets(batch.column(1), width):
            sizes.append(len(s))
            if not len(s):
                for column in (k1, k2, bands):
                    column.append(None)
                continue
            rows = minima(s).reshape(BANDS, ROWS).astype(np.uint64)
            key = common.mix((rows * _BAND[:, :ROWS]).sum(axis=1) + _BAND[:, ROWS])
            k1.append(int(common.mix(s).sum().view(np.int64)))
            k2.append(int(np.bitwise_xor.reduce(common.mix(s + np.uint64(77))).view(np.int64)))
            bands.append(key.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip((sizes, k1, k2, bands), kinds))],
            names=["doc_id", "n_shingles", "k1", "k2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], width: int = WIDTH) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s if len(s) else None for s in shingle_sets(batch.column(1), width)]
        least = [s if s is None else minima(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([s if s is None else s.tobytes() for s in sets], pa.binary()),
             pa.array([x if x is None else (x >> np.uint32(24) ^ x & np.uint32(255))
                       .astype(np.uint8).tobytes() for x in least], pa.binary())],
            names=["id", "shingles", "minima"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, set of a, set of b) to those (a, b) that reach the threshold."""
    for batch in batches:
        hit = []
        for x, y in zip(batch.column(2), batch.column(3)):
            left, right = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            at = np.searchsorted(left, right)
            at[at == len(left)] = 0
            both = int((left[at] == right).sum())
            hit.append(100 * both >= 80 * (len(left) + len(right) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                         names=["a", "b"]).filter(pa.array(hit, pa.bool_()))


class _Side:
    """One side of a block: ids, components, signatures and whole sets."""

    def __init__(self, rows: pa.Table):
        self.node, self.group = rows["node"].to_numpy(), rows["component"].to_numpy()
        self.bytes = np.frombuffer(b"".join(rows["minima"].to_pylist()), np.uint8).reshape(-1, MINIMA)
        self.sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        self.sizes = np.array([len(x) for x in self.sets], np.int64)

    def parts(self, most: int) -> Iterator[np.ndarray]:
        """Row numbers, in parts of bounded length and bounded number of shingles."""
        start = held = 0
        for i, n in enumerate(self.sizes):
            if i > start and (i - start == most or held + n > AT_ONCE):
                yield np.arange(start, i)
                start, held = i, 0
            held += n
        yield np.arange(start, len(self.sizes))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every left with every right set: incidence on the shingles that
    occur on both sides, multiplied."""
    x, y = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(x, y)
    total = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return total

    def incidence(sets: list[np.ndarray], values: np.ndarray, some: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(some, values), len(some) - 1)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        out = np.zeros((len(sets), len(some)), np.float32)
        hit = some[at] == values
        out[row[hit], at[hit]] = 1
        return out

    for k in range(0, len(shared), 8192):
        some = shared[k:k + 8192]
        total += incidence(left, x, some) @ incidence(right, y, some).T
    return total


class _Forest:
    """Components that the links so far have joined, by their least."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        top = x
        while top in above:
            top = above[top]
        while x != top:
            above[x], x = top, above[x]
        return top

    def roots(self, groups: np.ndarray) -> np.ndarray:
        return np.array([self.root(x) for x in groups.tolist()], np.int64)

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = sorted((self.root(x), self.root(y)))
        if x < y:
            self.above[y] = x
        return x < y


def _links(left: _Side, right: _Side, forest: _Forest) -> Iterator[pa.RecordBatch]:
    for i in left.parts(64):
        for j in right.parts(512):
            apart = forest.roots(left.group[i])[:, None] != forest.roots(right.group[j])[None, :]
            if not apart.any():
                continue
            agree = (left.bytes[i][:, None, :] == right.bytes[j][None, :, :]).sum(axis=2, dtype=np.uint16)
            may = (agree >= LEAST_AGREEMENT * MINIMA) & apart
            if not may.any():
                continue
            x, y = may.any(axis=1), may.any(axis=0)
            li, rj = i[x], j[y]
            both = _common([left.sets[k] for k in li], [right.sets[k] for k in rj]).astype(np.int64)
            size = left.sizes[li][:, None] + right.sizes[rj][None, :]
            a, b = np.nonzero((100 * both >= 80 * (size - both)) & apart[np.ix_(x, y)])
            new = [forest.join(p, q) for p, q in zip(left.group[li[a]].tolist(), right.group[rj[b]].tolist())]
            if any(new):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left.node[li[a[new]]]), pa.array(right.node[rj[b[new]]])], names=["a", "b"])


def _cross_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (bucket, l, r, side, node, component, shingles, minima) to the links between the
    left and the right rows of each block that join components which the links before left apart."""
    forest = _Forest()

    def compared(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        left, right = (rows.filter(pc.equal(rows["side"], s)) for s in (0, 1))
        if len(left) and len(right):
            yield from _links(_Side(left), _Side(right), forest)

    open_, key = [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            this = tuple(keys[a])
            if open_ and this != key:
                yield from compared(open_)
                open_ = []
            key = this
            open_.append(batch.slice(a, b - a))
    if open_:
        yield from compared(open_)


def sketch(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _sketches(batches, width), SKETCH)


def _sets_of(ids: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """Whole sets and signatures of some documents, made anew from their texts."""
    # A merge join whatever the sizes: the ids grow with the corpus.
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
            .mapInArrow(lambda batches: _sets(batches, width), "id long, shingles binary, minima binary").where("minima IS NOT NULL"))


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets reach the threshold."""
    of = {side: sets.select(F.col("id").alias(side), F.col("shingles").alias(f"_{side}"))
          for side in ("a", "b")}
    return (pairs.join(of["a"].hint("merge"), "a").join(of["b"].hint("merge"), "b")
            .select("a", "b", "_a", "_b").mapInArrow(_similar, "a long, b long"))


def _unsettled(members: DataFrame, groups: DataFrame, sets: DataFrame, done: DataFrame) -> DataFrame:
    """Links across components among the members of buckets; ``done`` pairs were checked before."""
    grouped = common.stored(
        join_per_key(members.select("bucket", "id"), groups.withColumnRenamed("node", "id"), "id", "left")
        .select("bucket", "id", F.coalesce("component", "id").alias("component")), "grouped")
    per_group = grouped.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("mark"),
        F.min("id").alias("a"), F.max("id").alias("b"))
    mixed = per_group.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"),
        F.max("n").alias("most"), F.count("*").alias("groups"), F.sum("mark").alias("mark"),
        F.min("a").alias("a"), F.max("b").alias("b")).where("groups > 1")
    # Buckets of the same members are one, and a bucket of a pair that was checked is settled.
    mixed = (mixed.groupBy("all", "mark", "a", "b").agg(F.min(F.struct("bucket", "main", "most")).alias("x"))
             .join(done.withColumn("all", F.lit(2).cast("long")), ["all", "a", "b"], "left_anti")
             .select("x.bucket", "x.main",
                     F.ceil((F.col("all") - F.col("x.most")) / LEFT_BLOCK).alias("lefts"),
                     F.ceil(F.col("all") / RIGHT_BLOCK).alias("rights")))
    rows = join_per_key(grouped, common.stored(mixed, "mixed"), "bucket").join(sets.hint("merge"), "id")
    slot = F.xxhash64("id")

    def one(side: int, own: str, other: str, chosen: DataFrame) -> DataFrame:
        x = chosen.withColumn("mine", F.pmod(slot, F.col(own))).withColumn(
            "their", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        pair = ("mine", "their") if side == 0 else ("their", "mine")
        return x.select("bucket", F.col(pair[0]).alias("l"), F.col(pair[1]).alias("r"),
                        F.lit(side).alias("side"), F.col("id").alias("node"), "component",
                        "shingles", "minima")

    both = one(0, "lefts", "rights", rows.where("component <> main")).unionByName(
        one(1, "rights", "lefts", rows))
    return (both.repartition("bucket", "l", "r").sortWithinPartitions("bucket", "l", "r")
            .mapInArrow(_cross_links, "a long, b long"))


def near_duplicates(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``; ``width`` is the
    number of words of a shingle, up to 5."""
    sketches = common.stored(sketch(documents, width), "sketches")
    sets = ["k1", "k2"]
    full = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    several = common.stored(classes.where("n > 1").drop("n"), "copies")
    placed = common.stored(
        join_per_key(sketches.select("doc_id", "n_shingles", *sets), several, sets, "left",
                     deal_by=["doc_id"])
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "placed")
    nodes = common.stored(
        join_per_key(full, several, sets, "left", deal_by=["doc_id"])
        .where("rep IS NULL OR rep = doc_id").dropDuplicates(["doc_id", *sets])
        .select("doc_id", "bands"), "nodes")
    # Several texts under one id make one document.
    split = placed.where("n_shingles > 0").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    same_id = split.join(placed, "doc_id").select("a", F.col("rep").alias("b"))

    entries = nodes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    # The orders of heads: by id, then by hashes of it.
    orders = [F.col("id"), *(F.xxhash64("id", F.lit(k)) for k in range(1, HEADS))]
    least = [F.min(F.struct(by.alias("at"), F.col("id").alias("head"))).alias(f"h{k}") for k, by in enumerate(orders)]
    heads = entries.groupBy("bucket").agg(*least, F.max("id").alias("last"))
    members = common.stored(
        join_per_key(entries, heads.where("h0.head < last").drop("last"), "bucket"), "members")
    sets = common.stored(_sets_of(members.select(F.col("id").alias("doc_id")).distinct(), documents, width), "sets")
    taken = members.groupBy("id").agg(*(F.min(f"h{k}").alias(f"h{k}") for k in range(HEADS)))
    head = F.explode(F.array(*(F.col(f"h{k}.head") for k in range(HEADS))))
    proposed = common.stored(
        taken.select("id", head.alias("head")).where("head <> id")
        .select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).distinct(), "proposed")
    known = common.stored(_checked(proposed, sets).unionByName(same_id), "links")
    rest = _unsettled(members, components(known, "a", "b"), sets, proposed)
    found = common.stored(known.unionByName(rest), "links")
    groups = components(found, "a", "b").withColumnRenamed("node", "rep")
    component = F.coalesce("component", "rep")
    return (join_per_key(placed, groups, "rep", "left", deal_by=["doc_id"])
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
