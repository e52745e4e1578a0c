"""What the operators share: tables, written intermediates, and words of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import scratch, session

# Rows per Arrow batch: whole texts travel in these batches, so they are kept short.
BATCH_ROWS = "512"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2^64


def prepare(spark: SparkSession) -> SparkSession:
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and go on from the files: cuts the lineage and survives lost
    executors."""
    return scratch.stored(df.sparkSession, df, purpose)


def crc_mod(n: int, key: str = "doc_id"):
    """crc32 of the id's text modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def clear_labels(labels: DataFrame, name: str) -> DataFrame:
    """One label per id; ids whose label rows disagree and ids without a label are left out."""
    return (labels.select("doc_id", F.col(name).cast("int").alias("label"))
            .dropna().groupBy("doc_id")
            .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
            .where("label = _most AND label IN (0, 1)").drop("_most"))


def bounded_sample(labels: DataFrame, per_label: int | dict[int, int], seed: int) -> DataFrame:
    """At most ``per_label`` ids of each label, by a seeded hash: the same on every run, and the
    result is bounded, so it may be broadcast and its rows may go to the driver."""
    most = per_label if isinstance(per_label, dict) else {0: per_label, 1: per_label}
    draw = F.xxhash64(F.lit(seed), "doc_id")
    parts = [labels.where(F.col("label") == value).orderBy(draw, "doc_id").limit(most[value])
             for value in (0, 1)]
    return parts[0].unionByName(parts[1])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_cached: list[tuple[np.ndarray, np.ndarray]] = []


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column one after another, and where each row begins; a null is an
    empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_string(column.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    at = np.frombuffer(offsets, kind, n + 1, column.offset * width).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about a megabyte that break no word, so that a very long text needs little room."""
    n, at = len(data), 0
    while at < n:
        size = _SLICE
        while True:
            end = min(at + size, n)
            if end == n:
                break
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            border = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(at + int(spaces[-1]) + 1 if len(spaces) else at, int(border))
            if cut > at:
                end = cut
                break
            size *= 2
        yield at, end
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray = ~_SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ([^\\x20\\x09-\\x0D]+, or a run of ``letter`` bytes) of one part,
    and of which row it is."""
    n = len(data)
    solid = letter[data]
    border = np.zeros(n + 1, bool)
    inside = offsets[(offsets >= 0) & (offsets <= n)]
    border[inside] = True
    before = np.concatenate(([False], solid[:-1]))
    after = np.concatenate((solid[1:], [False]))
    starts = np.flatnonzero(solid & (~before | border[:n]))
    ends = np.flatnonzero(solid & (~after | border[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word and the row it stands in, in order."""
    if not _cached:
        _cached.append(_powers(_SLICE + 1))
    hashes, rows = [], []
    for a, b in _pieces(data, offsets):
        part = data[a:b]
        up, down = _cached[0] if b - a <= _SLICE else _powers(b - a + 1)
        starts, ends, row = word_spans(part, offsets - a)
        if not len(starts):
            continue
        values = (_LOWER[part] if lower else part).astype(np.uint64)
        values += np.uint64(1)
        values *= up[:b - a]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
        hashes.append(mix((total[ends] - total[starts]) * down[starts]))
        rows.append(row)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


_K = [np.uint64(k) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                             0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words (up to 5); runs over a row's end are the caller's to
    leave out."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += h[i:i + n] * _K[i]
    return mix(total)


def letter_marks(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray, prefixes: tuple[int, ...],
                 salt: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Part by part: hashes (one row per prefix length in bytes, the last for the whole word) of
    every run of ``letter`` bytes, A-Z lowered, and the row each stands in. A word shorter than a
    prefix repeats its whole hash there."""
    if not _cached:
        _cached.append(_powers(_SLICE + 1))
    for a, b in _pieces(data, offsets):
        part = data[a:b]
        up, down = _cached[0] if b - a <= _SLICE else _powers(b - a + 1)
        starts, ends, row = word_spans(part, offsets - a, letter)
        if not len(starts):
            continue
        values = _LOWER[part].astype(np.uint64)
        values += np.uint64(1)
        values *= up[:b - a]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
        whole = mix((total[ends] - total[starts]) * down[starts] ^ salt)
        out = [np.where(ends - starts >= k,
                        mix((total[np.minimum(starts + k, ends)] - total[starts]) * down[starts]), whole)
               for k in prefixes]
        yield np.stack([*out, whole]), row
