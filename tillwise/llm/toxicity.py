"""Toxicity by weak supervision: many noisy voters, a label model, and a linear classifier.

Voters are small lexicons of one entry each (a word or a word's beginning; fixed insults, and those
that a bounded labelled sample finds telling) and ``PATTERNS``. Both vote. The label model is
generative and sees only votes: it estimates by expectation maximisation how often each voter
fires on toxic and on clean texts, and how far voters fire together beyond what the class explains;
voters that repeat each other share one voice. Its posterior labels, not the given ones, train a
logistic classifier over the voters, their number, and hashed word beginnings.

Samples are bounded (``TOXIC`` and ``CLEAN`` labelled texts, ``UNLABELLED`` others), so the
models are small whatever the corpus; scoring is one pass over whole texts.

Defined results: null and empty texts fire no voter and get the classifier's base score; without
labelled rows only the fixed voters vote; repeated rows are scored alike; ids whose label rows
disagree are not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm import common

TOXIC, CLEAN, UNLABELLED, SEED = 1500, 6000, 1000, 53
MOST_VOTERS, LEAST_SUPPORT, LEAST_PRECISION = 160, 6, 0.95
HASHED = 512
PATTERNS = ("shouting", "exclamation", "marks in a row", "letters drawn out", "masked word")
# Voters that fire together this often, given the class, share one voice.
SAME_VOICE = 0.7
START_ALONE, QUIET = 0.3, 2.0
EM_STEPS, TRAIN_STEPS, RATE, PENALTY = 50, 400, 0.5, 1e-3

# English insults that any list of abusive words holds.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash",
           "garbage", "pathetic", "worthless", "disgusting", "clown", "jerk", "fool", "creep",
           "imbecile", "bastard", "dimwit", "ugly", "vermin", "filth")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_PREFIXES = (4, 5)
_WHOLE = np.uint64(0x5851F42D4C957F2D)


def word_marks(texts: pa.Array) -> list[np.ndarray]:
    """For each text the distinct hashes of its words (runs of letters, A-Z lowered) and of their
    first 4 and 5 bytes."""
    data, offsets = common.text_bytes(texts)
    out: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
    for hashes, rows in common.letter_marks(data, offsets, _LETTER, _PREFIXES, _WHOLE):
        cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
        for i in np.unique(rows):
            out[i].append(np.unique(hashes[:, cuts[i]:cuts[i + 1]]))
    none = np.zeros(0, np.uint64)
    return [np.unique(np.concatenate(x)) if x else none for x in out]


def patterns(texts: pa.Array) -> np.ndarray:
    """One row per text, a column for each of ``PATTERNS``: mostly upper case; many exclamation marks;
    two of ! and ? in a row; a letter four times in a row; stars inside a word."""
    data, offsets = common.text_bytes(texts)

    def count(flags: np.ndarray, width: int = 1) -> np.ndarray:
        """How many flags each text has; a flag is at the first of ``width`` bytes of one text."""
        total = np.concatenate(([0], np.cumsum(flags), np.full(width - 1, flags.sum())))
        return total[np.maximum(offsets[1:] - width + 1, offsets[:-1])] - total[offsets[:-1]]

    def runs(*flags: np.ndarray) -> np.ndarray:
        """At least once these flags at bytes in a row."""
        n = max(len(data) - len(flags) + 1, 0)
        return count(np.logical_and.reduce([f[i:i + n] for i, f in enumerate(flags)]), len(flags)) > 0

    capital, low, loud = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122), data == 33
    upper, marks, small = count(capital), count(loud), count(low)
    size = np.maximum(offsets[1:] - offsets[:-1], 1)
    letter, star, mark = capital | low, data == 42, loud | (data == 63)
    lowered = data | np.where(capital, 32, 0).astype(data.dtype)
    again = np.zeros(len(data), bool)
    again[1:] = lowered[1:] == lowered[:-1]
    return np.stack([upper > 2 * small, 50 * marks > size, runs(mark, mark), runs(letter, again, again, again),
                     runs(letter, star, letter) | runs(letter, star, star, letter)], axis=1)


def _insults() -> np.ndarray:
    """The whole-word hashes of the fixed lexicon."""
    data, offsets = common.text_bytes(pa.array(INSULTS))
    return np.concatenate([h[-1] for h, _ in common.letter_marks(data, offsets, _LETTER, _PREFIXES, _WHOLE)])


@dataclass
class LabelModel:
    """Voters that fire or abstain given the class, with weights for voters that fire together.

    Voters of one language abstain on all texts of another, whatever the class, so abstentions
    together say no more than ``QUIET``.
    """
    prior: float
    rates: np.ndarray  # class by voter
    weights: np.ndarray
    correlations: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        on = self.weights * (np.log(self.rates[1]) - np.log(self.rates[0]))
        off = self.weights * (np.log1p(-self.rates[1]) - np.log1p(-self.rates[0]))
        abstained = np.maximum(off.sum() - votes @ off, -QUIET)
        return np.log(self.prior) - np.log1p(-self.prior) + votes @ on + abstained

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(votes))

    @property
    def accuracies(self) -> np.ndarray:
        """How often a voter that fires is right."""
        right = self.prior * self.rates[1]
        return right / (right + (1 - self.prior) * self.rates[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def label_model(votes: np.ndarray, steps: int = EM_STEPS, shapes: int = 0) -> LabelModel:
    """Fit to votes alone. The start believes texts on which voters agree, and half believes one
    voter; the last ``shapes`` voters, which go by a text's look, are one voter there."""
    n, m = votes.shape
    fired = votes[:, :m - shapes].sum(axis=1) + votes[:, m - shapes:].any(axis=1)
    q = np.select([fired == 0, fired == 1], [0.01, START_ALONE], 0.95)
    model = LabelModel(0.5, np.full((2, m), 0.5), np.ones(m), np.zeros((m, m)))
    for _ in range(steps if n else 0):
        prior = float(np.clip(q.mean(), 0.005, 0.99))
        rates = np.stack([((w @ votes) + 0.05) / (w.sum() + 1) for w in (1 - q, q)])
        rates = np.clip(rates, 1e-4, 1 - 1e-4)
        rates[0] = np.minimum(rates[0], rates[1])  # a voter speaks for toxic or not at all
        # Correlation of voters within the toxic class; together they count as one voice.
        hit = votes[q > 0.5]
        centred = hit - hit.mean(axis=0) if len(hit) else hit
        scale = np.sqrt((centred ** 2).sum(axis=0)) + 1e-9
        together = (centred.T @ centred) / np.outer(scale, scale)
        weights = 1 / np.clip(np.where(together > SAME_VOICE, together, 0).sum(axis=0), 1, None)
        model = LabelModel(prior, rates, weights, together)
        before, q = q, model.posterior(votes)
        if np.abs(q - before).max() < 1e-4:
            break
    return model


@dataclass
class Classifier:
    voters: np.ndarray  # sorted hashes
    coefficients: np.ndarray
    bias: float

    def features(self, texts: pa.Array) -> np.ndarray:
        return features(word_marks(texts), patterns(texts), self.voters)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(self.features(texts) @ self.coefficients + self.bias)


def votes_of(marks: list[np.ndarray], voters: np.ndarray) -> np.ndarray:
    out = np.zeros((len(marks), len(voters)), np.float64)
    for i, m in enumerate(marks):
        out[i] = np.isin(voters, m, assume_unique=True)
    return out


def all_votes(marks: list[np.ndarray], shapes: np.ndarray, voters: np.ndarray) -> np.ndarray:
    """The votes of the lexicon and, after them, of the patterns."""
    return np.hstack([votes_of(marks, voters), shapes.astype(np.float64)])


def features(marks: list[np.ndarray], shapes: np.ndarray, voters: np.ndarray) -> np.ndarray:
    """Votes, patterns, how many lexicon voters fire, and hashed marks in unit length."""
    votes = votes_of(marks, voters)
    hashed = np.zeros((len(marks), HASHED))
    for i, m in enumerate(marks):
        if len(m):
            hashed[i] = np.bincount((m % np.uint64(HASHED)).astype(np.int64), minlength=HASHED)
    norm = np.linalg.norm(hashed, axis=1, keepdims=True)
    hashed = np.divide(hashed, norm, out=np.zeros_like(hashed), where=norm > 0)
    return np.hstack([votes, shapes, np.minimum(votes.sum(axis=1, keepdims=True), 3), hashed])


def choose_voters(marks: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Marks that labelled texts find telling, most frequent first, and the fixed insults."""
    fixed = np.unique(_insults())
    toxic = [m for m, y in zip(marks, labels) if y == 1]
    if not toxic:
        return fixed
    hits, n = np.unique(np.concatenate(toxic), return_counts=True)
    clean = [m for m, y in zip(marks, labels) if y == 0]
    found, others = np.unique(np.concatenate(clean), return_counts=True) if clean else (hits[:0], n[:0])
    at = np.searchsorted(found, hits)
    at[at == len(found)] = 0
    wrong = np.where(found[at] == hits, others[at], 0) if len(found) else np.zeros(len(hits))
    good = (n >= LEAST_SUPPORT) & (n >= LEAST_PRECISION * (n + wrong))
    order = np.lexsort((hits[good], -n[good]))[:MOST_VOTERS]
    return np.unique(np.concatenate([fixed, hits[good][order]]))


def train(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels by gradient descent with momentum."""
    # Both classes weigh the same, whatever their share of the sample.
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3)) if len(x) else 0.5
    weight = target / (2 * share) + (1 - target) / (2 * (1 - share))
    beta, bias = np.zeros(x.shape[1]), 0.0
    speed, pace = np.zeros_like(beta), 0.0
    for _ in range(TRAIN_STEPS if len(x) else 0):
        error = weight * (_sigmoid(x @ beta + bias) - target) / len(x)
        speed = 0.9 * speed - RATE * (x.T @ error + PENALTY * beta)
        pace = 0.9 * pace - RATE * error.sum()
        beta, bias = beta + speed, bias + pace
    return beta, bias


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = word_marks(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([m.tobytes() for m in marks], pa.binary()),
             pa.array([p.tobytes() for p in patterns(batch.column(1))], pa.binary())],
            names=["doc_id", "label", "marks", "patterns"])


def learn(documents: DataFrame, labels: DataFrame) -> tuple[Classifier, LabelModel]:
    """``labels`` holds doc_id and label of the documents that may be learnt from; a bounded sample
    of them and of other documents comes to the driver as hashes."""
    draw = F.xxhash64(F.lit(SEED), "doc_id")
    known = common.bounded_sample(labels, {0: CLEAN, 1: TOXIC}, SEED)
    # Other documents are drawn from all, by hash; they come without a label.
    other = (documents.select(F.col("doc_id").cast("long").alias("doc_id")).dropna()
             .orderBy(draw, "doc_id").limit(UNLABELLED).distinct())
    sample = known.unionByName(other.join(F.broadcast(known), "doc_id", "left_anti")
                               .withColumn("label", F.lit(-1)))
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
            .select("doc_id", "text", "label")
            .mapInArrow(_sampled, "doc_id long, label int, marks binary, patterns binary")
            .orderBy("doc_id").toArrow())
    marks = [np.frombuffer(x, np.uint64) for x in rows["marks"].to_pylist()]
    given = rows["label"].to_numpy()
    shapes = np.array([np.frombuffer(x, bool) for x in rows["patterns"].to_pylist()]).reshape(-1, len(PATTERNS))
    voters = choose_voters(marks, given)
    votes = all_votes(marks, shapes, voters)
    model = label_model(votes, shapes=len(PATTERNS))
    beta, bias = train(features(marks, shapes, voters), model.posterior(votes))
    return Classifier(voters, beta, bias), model


def _scored(classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classifier.scores(batch.column(1)))], names=["doc_id", "score"])
    return run


def score(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score of every row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scored(classifier), "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from the ids outside the held-out fold."""
    known = common.clear_labels(labels, "toxic").where(common.crc_mod(folds) != held)
    classifier, _ = learn(documents, known)
    return score(documents, classifier).select(
        "doc_id", F.coalesce(common.crc_mod(folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
