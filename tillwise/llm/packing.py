"""Pack tokenised documents into as few sequences of ``CAPACITY`` tokens as can be.

One pass tokenises, cuts documents longer than a sequence, and writes a narrow row per piece. Only
the pieces' length histogram (at most ``CAPACITY`` rows) comes to the driver, where the
configuration program over it is solved by multiplicative weights: a length's price falls as it gets
covered, a knapsack bounded by the pieces left finds the configuration of highest price, and it is
used for a part of its scarcest length. A pass ends when every length is covered, and the cover is
held against a dual bound. Steps are whole sequences, so nothing is lost by rounding; only where it
saves sequences, best-fit decreasing over the histogram packs what the cover's last or unfilled
configurations hold. So the driver's work depends on the number of distinct lengths, not on the
number of documents.

A configuration used k times is k sequences in a row, and for each of its places a run of k
consecutive pieces of one length. Pieces are ranked within their length and looked up in these runs.

Defined results: a null text is empty and gives one piece with the end token alone; repeated rows
are packed one by one; a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillwise.llm import common

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END = 1
# Pieces of one length are cut into so many parts by a hash, so none is one task.
PARTS = 256
# With no rounds there is no cover; their number bounds nothing.
ROUNDS = 400
# Of each pass: the part of the scarcest length that a step covers, and how fast prices fall.
PASSES = ((1 / 8, 0.05), (1 / 16, 1.0), (1 / 32, 4.0))
# When a cover is close to its bound, how often a pass takes the bound, lengths of a group.
GAP, BOUNDS, GROUP, SEED = 0.001, 8, 48, 59
# Shares of a cover's last sequences that best fit may pack anew.
TAILS = (0, 1 / 256, 1 / 64, 1 / 16, 1 / 4)
# Words whose tokens a worker keeps; any others are tokenised each time.
KEPT_WORDS, KEPT_LENGTH = 600_000, 48

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Letters that lower-case alone and compose with nothing, and punctuation: the tokenizer splits such
# a word in two just there. All other words go through the tokenizer as they are.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
# A point after a letter and before white space is a token of its own, whatever the word.
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[\x20\x09-\x0D])")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for 256 and up."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens(dict):
    """Word (bytes without white space) to its ids as little-endian 32-bit integers.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids
    one after another, and frequent words are looked up.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        letters = _byte_letters()
        self.letters = [letters[b] for b in range(256)]

    def _bpe(self, plain: bytes) -> bytes:
        said = (plain.decode("ascii") if plain.isascii()
                else "".join([self.letters[b] for b in plain]))
        return _packed([t.id for t in self.model.tokenize(said)])

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            ids = _packed(self.whole.encode(text, add_special_tokens=False).ids)
        else:
            low, rest = plain[1].lower().encode(), plain[2].encode()
            ids = self._bpe(low) if low == word else self[low]
            if rest:
                ids += self._bpe(rest)
        self._keep(word, ids)
        return ids

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(self) < KEPT_WORDS and len(word) <= KEPT_LENGTH:
            self[word] = ids

    def ids(self, text: bytes) -> bytes:
        # A special token's letters count as written.
        low = text if b"<|" in text else text.lower()
        return b"".join(map(self.__getitem__, _STOP.sub(rb" \1", low).split()))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            data, offsets = common.text_bytes(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                ids = tokens.ids(data[offsets[i]:offsets[i + 1]].tobytes()) + end
                for k, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    piece = ids[at:at + 4 * CAPACITY]
                    rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(documents: DataFrame, path: str) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cut(path), PIECES)


def _items(lengths: np.ndarray, copies: np.ndarray, capacity: int) -> Iterator[tuple[int, int]]:
    """(length, number): each length in bundles of 1, 2, 4, ... that give any number up to its copies."""
    for length, n in zip(lengths.tolist(), np.minimum(copies, capacity // lengths).tolist()):
        bundle = 1
        while n > 0:
            yield length, min(bundle, n)
            n -= bundle
            bundle *= 2


def _highest(prices: np.ndarray, copies: np.ndarray, capacity: int) -> float:
    """The price of the dearest configuration, with at most ``copies`` of each length."""
    best, lengths = np.zeros(capacity + 1), np.flatnonzero((copies > 0) & (prices > 0))
    for length, n in _items(lengths, copies[lengths], capacity):
        size = length * n
        np.maximum(best[size:], best[:capacity + 1 - size] + prices[length] * n, out=best[size:])
    return float(best[-1])


def _dearest(lengths: np.ndarray, prices: np.ndarray, copies: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of highest price of these lengths: a knapsack bounded by ``copies``."""
    best, took = np.zeros(capacity + 1), []
    for length, n in _items(lengths, copies[lengths], capacity):
        size = length * n
        worth = best[:capacity + 1 - size] + prices[length] * n
        took.append((length, n, size, worth > best[size:]))
        np.maximum(best[size:], worth, out=best[size:])
    found: dict[int, int] = {}
    room = capacity
    for length, n, size, better in reversed(took):
        if size <= room and better[room - size]:
            found[length] = found.get(length, 0) + n
            room -= size
    return found


def _pass(need: np.ndarray, capacity: int, part: float, rate: float, rng: np.random.Generator
          ) -> tuple[dict[tuple, float], float]:
    """One cover of all of ``need`` and the best dual bound on its way."""
    lengths = np.flatnonzero(need)
    left, use, bound, seen = need.copy(), {}, 0.0, 0
    total = int((need * np.arange(capacity + 1)).sum())
    while (active := np.flatnonzero(left)).size:
        prices = np.zeros(capacity + 1)
        prices[active] = active * np.exp(-rate * (1 - left[active] / need[active]))
        gone = 1 - (left[active] * active).sum() / total
        if gone * BOUNDS >= seen:
            bound = max(bound, float((prices * need).sum()) / _highest(prices, need, capacity))
            seen = int(gone * BOUNDS) + 1
        # Lengths are dealt to groups, short and long ones to each, so a sweep finds many configurations.
        groups = max(1, active.size // GROUP)
        order = np.argsort(np.arange(active.size) // groups + rng.random(active.size), kind="stable")
        for g in range(groups):
            group = active[order[g::groups]]
            found = _dearest(group, prices, left, capacity)
            times = min(min(int(left[k]) // n, max(1, int(part * need[k]) // n)) for k, n in found.items())
            for k, n in found.items():
                left[k] -= n * times
            key = tuple(sorted(found.items()))
            use[key] = use.get(key, 0.0) + times
    return use, bound


def _plain_bound(need: np.ndarray, capacity: int) -> float:
    """The best of the volume and of prices that count a length in fractions of a sequence, which no
    configuration exceeds (Fekete and Schepers)."""
    size = np.arange(capacity + 1)
    bounds = [float((size * need).sum()) / capacity]
    for m in range(1, 41):
        exact = (m + 1) * size % capacity == 0
        bounds.append(float((np.where(exact, size / capacity, (m + 1) * size // capacity / m) * need).sum()))
    return max(bounds)


def cover(need: np.ndarray, capacity: int, rounds: int) -> tuple[dict[tuple, float], float]:
    """Configurations in the order found, how often each is used in a cover of all of ``need``, and a
    lower bound of every cover.

    Multiplicative weights: a length's price is its size times a weight that falls as it gets
    covered. A step uses the dearest configuration of a group of lengths for a part of its scarcest
    one, in whole sequences. Prices over the highest price of a configuration bound every cover from
    below. Finer passes follow until the cover is close to the bound; the best one stands.
    """
    need = need.astype(np.int64)
    if not rounds or not need.any():
        return {}, 0.0
    best, bound, rng = {}, _plain_bound(need, capacity), np.random.default_rng(SEED)
    for part, rate in PASSES:
        use, found = _pass(need, capacity, part, rate, rng)
        bound = max(bound, found)
        if not best or sum(use.values()) < sum(best.values()):
            best = use
        if sum(best.values()) <= max(np.ceil(bound - 1e-6), (1 + GAP) * bound):
            break
    return best, bound


def fractional(need: np.ndarray, capacity: int, rounds: int) -> dict[tuple, float]:
    """Configurations and how often each is used in a cover of the histogram ``need``."""
    return cover(need, capacity, rounds)[0]


def _kept(use: dict[tuple, float], tail: float, least: int) -> list[tuple[dict[int, int], int]]:
    """What is used before the last ``tail`` of the sequences and holds ``least`` tokens."""
    room, out = int(sum(use.values()) * (1 - tail)), []
    for config, n in use.items():
        times = min(int(n), room)
        room -= times
        if times and sum(k * m for k, m in config) >= least:
            out.append((dict(config), times))
    return out


def configurations(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS
                   ) -> list[tuple[dict[int, int], int]]:
    """Configurations (length to number) and how often each is used; together they hold exactly
    ``counts``. The whole cover stands unless fewer sequences come of packing its last or unfilled
    ones anew by best fit, or all."""
    need = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        need[length] = n
    use, bound = cover(need, capacity, rounds)
    best, fewest = [], None
    for tail, least in [*((t, 0) for t in TAILS), *((t, capacity) for t in (0, *TAILS[-2:])), (1, 0)]:
        out, left = _kept(use, tail, least), need.copy()
        for config, times in out:
            for k, n in config.items():
                left[k] -= n * times
        out += _best_fit(left, capacity)
        total = sum(times for _, times in out)
        if fewest is None or total < fewest:
            best, fewest = out, total
        if fewest <= np.ceil(bound - 1e-6):
            break
    return best


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: the longest piece, then always the longest that still
    fits; the configuration is repeated while its pieces last."""
    out, lengths = [], [int(k) for k in np.flatnonzero(left)]
    while lengths:
        config: dict[int, int] = {}
        room, at = capacity, len(lengths) - 1
        while at >= 0:
            length = lengths[at]
            n = min(room // length, int(left[length]))
            if n:
                config[length] = n
                room -= n * length
            at = min(at, int(np.searchsorted(lengths, room, "right"))) - 1
        times = min(int(left[k]) // n for k, n in config.items())
        for k, n in config.items():
            left[k] -= n * times
        lengths = [k for k in lengths if left[k]]
        out.append((config, times))
    return out


def _runs(used: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence, offset), by length and first rank."""
    rows, ranks, sequence = [], {}, 0
    for config, times in used:
        offset = 0
        for length in sorted(config, reverse=True):
            for _ in range(config[length]):
                rows.append((length, ranks.get(length, 0), sequence, offset))
                ranks[length] = ranks.get(length, 0) + times
                offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _placed(runs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = (runs[:, 0] << 48) + runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(firsts, (length << 48) + rank, "right") - 1
            sequence = runs[at, 2] + rank - runs[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(runs[at, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(documents: DataFrame, path: str) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    cut = common.stored(pieces(documents, path), "pieces")
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)).cast("int")
    cells = common.stored(cut.groupBy("length", part.alias("part")).agg(F.count("*").alias("n")), "cells")
    # At most CAPACITY rows reach the driver.
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = _runs(configurations(counts))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "part").orderBy(F.xxhash64(F.lit(5), "doc_id", "piece"), "doc_id", "piece")
    return (cut.withColumn("part", part).join(first, ["length", "part"])
            .withColumn("rank", F.col("first") + F.row_number().over(own) - 1)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(_placed(runs), PIECES + ", sequence_id long, offset long"))
