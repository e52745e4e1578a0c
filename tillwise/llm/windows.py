"""Pack tokenised documents into windows of ``CAPACITY`` tokens with no padding but where documents
run out.

Documents longer than a window are first cut into full windows; what is left of each is a piece.
Pieces are placed by best-fit decreasing: a segment tree indexed by remaining capacity finds the
tightest open window that has room. Pieces of one length are alike, so the plan is made from their
histogram: windows of the same contents are one range of numbers, a leaf of the tree holds the ranges
with that capacity left, and a range takes pieces for all its windows at once, just as one after
another would have gone. The driver gets one row per length, at most ``CAPACITY``, and its work
depends on that, not on the number of documents.

Windows that are not full then are filled: the fullest ones that the tokens of all of them can fill
stay, the others give up their tokens, in order, to the gaps, and pieces are cut where a gap ends. What
remains after the last gap makes windows of powers of two, which need no padding either.

Pieces are numbered as they are written, so none is sorted: a task numbers its pieces per length, and
sums of the tasks' counts give each task its place. So no length is one task. Texts are read once;
tokens are kept only of pieces shorter than a window. Once the plan is made, the pieces that are given
up are told by a few ranges of tasks and places, and only their tokens leave the files again.

Defined results: a null text is empty and gives one piece with the end token alone; repeated rows are
packed one by one; a null doc_id stays null; an empty table gives no rows. A very long text is
tokenised in parts of about ``PART`` characters, cut where a space stands between letters or digits,
which changes no token; a text without such a place is one part. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.llm import common

TOKENIZER = "byte_bpe_50k.json"
CAPACITY, END = 1024, 0
PART = 1 << 18
# What the vocabulary's pre-tokenizer parts words by.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BREAK = re.compile(r"(?<=[^\W_]) (?=[^\W_])")

PIECES = "task int, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, place long, ids binary"


class Tokens:
    """Ids of whole texts by the vocabulary file, a special token's text giving its id.

    The vocabulary is read from its file and run by the byte-pair encoder that is the faster of the
    installed ones; both give the same ids.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        ranks = self._ranks(said["model"]["vocab"])
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.special = set(special)
        self.encoder = tiktoken.Encoding("words", pat_str=_WORDS, special_tokens=special, mergeable_ranks={
            word: i for word, i in ranks.items() if i not in special.values()})

    @staticmethod
    def _ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
        """The vocabulary's words as bytes: printable bytes stand for themselves, others for 256 and up."""
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in kept]
        byte = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
        return {bytes(byte[c] for c in word): i for word, i in vocabulary.items() if all(c in byte for c in word)}

    def ids(self, text: str) -> np.ndarray:
        found, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > PART:
                gap = _BREAK.search(text, at + PART)
                end = gap.start() if gap else end
            found.append(np.array(self.encoder.encode(text[at:end], allowed_special=self.special), "<u4"))
            at = end
        return np.concatenate([*found, np.array([END], "<u4")])


_loaded: dict[str, Tokens] = {}


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = Tokens(path)
        tokens, task, places = _loaded[path], TaskContext.get().partitionId(), [0] * (CAPACITY + 1)
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [part.split()[0] for part in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                ids = tokens.ids(text or "")
                for at in range(0, len(ids), CAPACITY):
                    piece = ids[at:at + CAPACITY].tobytes()
                    n = len(piece) // 4
                    rows.append((task, doc_id, at, n, zlib.crc32(piece), len(ids), places[n],
                                 piece if n < CAPACITY else None))
                    places[n] += 1
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    return run


class OpenWindows:
    """Ranges of open windows by remaining capacity, with a segment tree over the capacities."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        # A node counts the ranges below it; leaf c is the capacity c.
        self.counts = [0] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, room: int, first: int, n: int) -> None:
        if n:
            self.ranges[room].append((first, n))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.ranges[room].pop()

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has left."""
        node = least + self.size
        if self.counts[node]:
            return least
        # Up to the first subtree to the right that holds anything, then down its left edge.
        while node > 1:
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                break
            node >>= 1
        if node <= 1:
            return None
        while node < self.size:
            node *= 2
            node += not self.counts[node]
        return node - self.size


class Plan:
    """Where every piece goes: runs of pieces of one length into ranges of windows."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.windows = capacity, 0
        # (length, first place, windows, pieces in each, first window, offset)
        self.runs: list[tuple[int, ...]] = []
        self.open = OpenWindows(capacity)
        for length in sorted(counts, reverse=True):
            self._place(length, counts[length])
        self._fill()

    def _place(self, length: int, n: int) -> None:
        placed = 0
        while placed < n:
            room = self.open.tightest(length)
            if room is None:
                # As many new windows as the rest needs; a window takes all it can before the next.
                room, each = self.capacity, self.capacity // length
                first, windows = self.windows, -(-(n - placed) // each)
                self.windows += windows
            else:
                first, windows = self.open.take(room)
                each = room // length
            full = min(windows, (n - placed) // each)
            offset = self.capacity - room
            if full:
                self.runs.append((length, placed, full, each, first, offset))
                self.open.put(room - each * length, first, full)
                placed += full * each
            rest = min(each, n - placed) if full < windows else 0
            if rest:
                self.runs.append((length, placed, 1, rest, first + full, offset))
                self.open.put(room - rest * length, first + full, 1)
                placed += rest
            left = full + (1 if rest else 0)
            if room < self.capacity:
                self.open.put(room, first + left, windows - left)

    def _fill(self) -> None:
        """Choose what stays, what is given up, and where its tokens go."""
        ranges = [(self.capacity - room, first, n) for room, found in enumerate(self.open.ranges) for first, n in found
                  if room and (self.capacity - room) & (self.capacity - room - 1)]
        ranges.sort(key=lambda r: (-r[0], r[1]))
        total = sum(content * n for content, _, n in ranges)
        stay, self.rest = divmod(total, self.capacity)
        # (first window, windows, tokens in each, first token) of the stream of given up tokens, and
        # (first window, windows, room in each, first token) of the gaps it fills.
        self.given, self.gaps = [], []
        at = filled = 0
        for content, first, n in ranges:
            kept = min(n, stay)
            stay -= kept
            if kept:
                self.gaps.append((first, kept, self.capacity - content, filled))
                filled += kept * (self.capacity - content)
            if n > kept:
                self.given.append((first + kept, n - kept, content, at))
                at += (n - kept) * content
        # What no gap takes: windows of powers of two.
        window = self.windows
        for bit in reversed(range(self.rest.bit_length())):
            if self.rest >> bit & 1:
                self.gaps.append((window, 1, 1 << bit, filled))
                filled += 1 << bit
                window += 1
        self.fresh = self.windows

    def sequences(self) -> int:
        return self.windows - sum(n for _, n, _, _ in self.given) + self.rest.bit_count()

    def moved(self) -> list[tuple[int, int, int]]:
        """(length, first place, last place) of the pieces that are given up, as ranges of places."""
        given, found = sorted(self.given), []
        firsts = [first for first, *_ in given]
        for length, placed, windows, each, first, _ in sorted(self.runs):
            for begin, n, _, _ in given[max(bisect(firsts, first) - 1, 0):bisect(firsts, first + windows - 1)]:
                low, end = max(first, begin), min(first + windows, begin + n)
                if low < end:
                    low, last = placed + (low - first) * each, placed + (end - first) * each - 1
                    if found and found[-1][0] == length and found[-1][2] == low - 1:
                        low = found.pop()[1]
                    found.append((length, low, last))
        return found

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        runs = np.array(sorted(self.runs), np.int64).reshape(-1, 6)
        return (runs, np.array(sorted(self.given), np.int64).reshape(-1, 4), np.array(self.gaps, np.int64).reshape(-1, 4))


def _placed(plan: Plan):
    runs, given, gaps = plan.tables()
    capacity, fresh = plan.capacity, plan.fresh
    firsts = (runs[:, 0] << 48) + runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("length", "rank"))
            at = np.searchsorted(firsts, (length << 48) + rank, "right") - 1
            window, place = np.divmod(rank - runs[at, 1], runs[at, 3])
            window, offset = window + runs[at, 4], runs[at, 5] + place * length
            # Each row as it is, or once per part of a given up piece.
            row, skip, size = np.arange(len(rank)), np.zeros(len(rank), np.int64), length
            if len(given):
                g = np.searchsorted(given[:, 0], window, "right") - 1
                moved = np.flatnonzero((g >= 0) & (window < given[g, 0] + given[g, 1]))
                if len(moved):
                    parts = [[i, s, n, w, o] for i in moved.tolist() for s, n, w, o in _parts(
                        int(given[g[i], 3] + (window[i] - given[g[i], 0]) * given[g[i], 2] + offset[i]), int(length[i]))]
                    parts = np.array(parts, np.int64)
                    stay = np.setdiff1d(row, moved)
                    row, skip, size, window, offset = (np.concatenate((x, y)) for x, y in (
                        (stay, parts[:, 0]), (skip[stay], parts[:, 1]), (length[stay], parts[:, 2]),
                        (window[stay], parts[:, 3]), (offset[stay], parts[:, 4])))
            out = pa.Table.from_batches([batch.select(["doc_id", "start", "ids_crc32", "doc_tokens"])]).take(pa.array(row))
            crc32, held = out["ids_crc32"].to_numpy().copy(), batch.column("ids")
            for i in np.flatnonzero(size < length[row]).tolist():
                crc32[i] = zlib.crc32(held[int(row[i])].as_py()[4 * skip[i]:4 * (skip[i] + size[i])])
            yield from pa.table({
                "doc_id": out["doc_id"], "start": out["start"].to_numpy() + skip, "length": size, "ids_crc32": crc32,
                "doc_tokens": out["doc_tokens"], "sequence_id": window, "offset": offset}).to_batches()

    def _parts(token: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(skip, length, window, offset) of the parts of n given up tokens from the given one on."""
        done = 0
        while done < n:
            first, _, room, base = gaps[np.searchsorted(gaps[:, 3], token, "right") - 1].tolist()
            window, inside = divmod(token - base, room)
            size = min(n - done, room - inside)
            begin = 0 if first >= fresh else capacity - room
            yield done, size, first + window, begin + inside
            done += size
            token += size

    return run


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _lightened(cut: DataFrame, first: DataFrame, moved: list[tuple[int, int, int]]) -> DataFrame:
    """Pieces, of which only those in the ranges of places still hold their tokens.

    Pieces of one length are placed by task and number, so a range of places goes from a task and
    number to another: there are as many of these as the plan has ranges, whatever the number of tasks.
    """
    if not moved:
        return cut.withColumn("ids", F.lit(None).cast("binary"))
    spark, spot = cut.sparkSession, lambda at: F.shiftleft(F.col("task").cast("long"), 40) + F.col(at)
    ends = spark.createDataFrame(sorted({(length, at) for length, *both in moved for at in both}), "length int, rank long")
    found = (first.join(F.broadcast(ends), "length").where("rank >= first AND rank < first + n")
             .withColumn("place", F.expr("rank - first")))
    spots = {(r.length, r.rank): r.spot for r in found.select("length", "rank", spot("place").alias("spot")).collect()}
    ranges = spark.createDataFrame([(length, spots[length, low], spots[length, last]) for length, low, last in moved],
                                   "of int, low long, last long")
    inside = (F.col("length") == F.col("of")) & spot("place").between(F.col("low"), F.col("last"))
    return (cut.join(F.broadcast(ranges), inside, "left")
            .withColumn("ids", F.when(F.col("of").isNotNull(), F.col("ids"))).drop("of", "low", "last"))


def pack(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    cut = common.stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .mapInArrow(_cut(path), PIECES), "pieces")
    cells = common.stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "cells")
    # At most CAPACITY rows reach the driver.
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return (_lightened(cut, first, plan.moved()).join(first.drop("n"), ["task", "length"])
            .withColumn("rank", F.col("first") + F.col("place"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids")
            .mapInArrow(_placed(plan), PLACED))
