"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms of a text are hashed into ``BUCKETS``: pairs of neighbouring bytes, and how often a word or
a pair of words has been seen before (which tells repeated text from prose of the same letters). So
the space is one of byte pairs: no word is a term of its own, texts of unlike words but like letters
are near each other, and repeated lines show only through their words. A bounded
sample of labelled documents (``PER_LABEL`` of each label) fixes the terms' inverse document
frequencies and a singular value decomposition of ``RANK`` dimensions; both are small and of fixed
size, whatever the corpus. The sample's vectors and labels go to every task, where each document's
vector is compared with all of them in blocks: exact cosines, the ``NEIGHBOURS`` best vote by label,
weighted by similarity. Labels are balanced in the sample, so a score of 0.5 is an even vote.

Defined results: a null or empty text has no direction and gets the share of label 1 in the sample
as its score, as do all texts when no labelled document is at hand; repeated rows are scored alike;
ids whose label rows disagree are not learnt from.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm import common

BUCKETS, RANK, NEIGHBOURS = 2048, 64, 25
PER_LABEL = 1500
# Weights are similarities raised to this power, so that near ones count for more.
SHARPNESS = 8
SEED, BLOCK = 31, 1024
FOLDS, HELD, KEEP = 4, 2, 0.7
_PAIRS = 1792  # buckets of byte pairs; the others hold repetition


_pair = (common.mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(_PAIRS)).astype(np.int64)


def _repeats(items: np.ndarray) -> np.ndarray:
    """How often each item has come before, in steps of powers of two (0, 1, 2-3, 4-7, ...)."""
    order = np.argsort(items, kind="stable")
    ranked = items[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    at = np.arange(len(items))
    earlier = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.bincount(np.frexp(earlier)[1], minlength=16)[:16]


def term_counts(texts: pa.Array) -> np.ndarray:
    """One row of hashed term counts per text."""
    data, offsets = common.text_bytes(texts)
    out = np.zeros((len(texts), BUCKETS), np.float32)
    h, rows = common.word_hashes(data, offsets, lower=False)
    ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts)))))
    for i in range(len(texts)):
        part = data[offsets[i]:offsets[i + 1]]
        for at in range(0, len(part) - 1, common._SLICE):
            b = part[at:at + common._SLICE + 1].astype(np.uint16)
            pairs = np.bincount((b[:-1] << 8) | b[1:], minlength=1 << 16)
            out[i, :_PAIRS] += np.bincount(_pair, weights=pairs, minlength=_PAIRS)
        words = h[ends[i]:ends[i + 1]]
        if len(words):
            out[i, _PAIRS:_PAIRS + 16] = _repeats(words)
            out[i, _PAIRS + 16:_PAIRS + 32] = _repeats(common.windows(words, 2)) if len(words) > 1 else 0
    return out


@dataclass
class Space:
    """Fitted term weights, projection, and the labelled vectors."""
    frequency: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = weighted(counts, self.frequency) @ self.axes
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), prior)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        for at in range(0, len(counts), BLOCK):
            x = self.project(counts[at:at + BLOCK])
            cosine = x @ self.vectors.T
            best = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cosine, best, 1), 0, 1).astype(float) ** SHARPNESS
            total = weight.sum(axis=1)
            vote = (weight * self.labels[best]).sum(axis=1)
            some = (total > 0) & x.any(axis=1)
            out[at:at + BLOCK][some] = np.clip(vote[some] / total[some], 0, 1)
        return out


def weighted(counts: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Relative counts, dampened, by inverse document frequency, in unit length per kind of term."""
    out = np.zeros_like(counts)
    for a, b in ((0, _PAIRS), (_PAIRS, _PAIRS + 16), (_PAIRS + 16, _PAIRS + 32)):
        x = np.sqrt(counts[:, a:b]) * frequency[a:b]
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        out[:, a:b] = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    return out


def fit(counts: np.ndarray, labels: np.ndarray) -> Space:
    """Latent-semantic space of labelled documents; terms and sample are bounded."""
    frequency = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = weighted(counts, frequency)
    # Left singular vectors of the small term-by-term matrix; its size does not follow the data.
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    space = Space(frequency, np.ascontiguousarray(axes[:, ::-1][:, :RANK]).astype(np.float32),
                  np.zeros((0, RANK), np.float32), labels.astype(float))
    space.vectors = space.project(counts)
    return space


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = term_counts(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([c.tobytes() for c in counts], pa.binary())],
            names=["doc_id", "label", "counts"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the sample, in any order, to one pickled space."""
    rows = pa.Table.from_batches([b for b in batches if len(b)] or [
        pa.RecordBatch.from_pydict({"doc_id": pa.array([], pa.int64()), "label": pa.array([], pa.int32()),
                                    "counts": pa.array([], pa.binary())})]).sort_by("doc_id")
    counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.float32).reshape(-1, BUCKETS)
    space = fit(counts, rows["label"].to_numpy())
    yield pa.RecordBatch.from_pydict({"space": pa.array([pickle.dumps(space)], pa.binary())})


def learn(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Space:
    """``labels`` holds doc_id and label of the documents that may be learnt from.

    The sample is of bounded size, so one task fits the space; only the space, about a megabyte,
    comes to the driver."""
    sample = common.bounded_sample(labels, per_label, SEED)
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
            .dropDuplicates(["doc_id"]).select("doc_id", "text", "label")
            .mapInArrow(_counted, "doc_id long, label int, counts binary"))
    fitted = rows.repartition(1).mapInArrow(_fitted, "space binary").first()
    if fitted is None:  # no labelled document at all
        return fit(np.zeros((0, BUCKETS), np.float32), np.zeros(0, np.int64))
    return pickle.loads(fitted.space)


def with_score(space: Space, keep_text: bool = True):
    """For mapInArrow: the rows as they are (without the text, unless it is kept), and their score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(space.scores(term_counts(batch.column("text"))))
            names = [n for n in batch.schema.names if keep_text or n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), score], names=[*names, "score"])
    return run


def score(documents: DataFrame, space: Space) -> DataFrame:
    """doc_id and score of every row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        with_score(space, keep_text=False), "doc_id long, score double")


def training_labels(labels: DataFrame, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """The labels that may be learnt from: those outside the held-out fold."""
    return common.clear_labels(labels, "quality").where(common.crc_mod(folds) != held)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(documents, learn(documents, training_labels(labels)))
    return scored.select(
        "doc_id", F.coalesce(common.crc_mod(FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= KEEP).cast("int").alias("predicted"))
