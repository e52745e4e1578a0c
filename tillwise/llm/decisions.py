"""Quality rules learnt as an ordered decision list over text statistics.

One pass counts statistics of every whole text. A bounded sample of labelled rows (``PER_LABEL`` of
each label) is learnt from on the driver by sequential covering: a rule is a conjunction of
thresholds, grown on two thirds of the rows by information gain, cut back on the last third, and
accepted while it is precise there; the rows it covers are set aside and the next rule is sought.
The list becomes one Spark CASE expression, so any number of rows is judged by built-in functions.

Defined results: a null text has no words, so it fails the base rules; so does an empty one. Without
labelled rows of both labels the list is empty and only the base rules judge. Repeated rows are
judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm import common

LEAST_WORDS, MOST_REPEAT = 50, 50
PER_LABEL, SEED = 3000, 17
MOST_RULES, MOST_TERMS, MOST_TRIES, LEAST_PRECISION = 12, 4, 8, 0.9

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct",
          "n_doubled", "n_upper", "n_lines", "n_bytes")
STATISTICS = ", ".join(f"{c} long" for c in COUNTS)
# What rules may speak of, in SQL over the counts. A text without words has no ratios: zero.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "doubled_share": "n_doubled / greatest(n_words, 1)",
    "upper_per_char": "n_upper / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "words": "cast(n_words as double)",
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(batch)
        data, offsets = common.text_bytes(batch.column(1))
        h, rows = common.word_hashes(data, offsets, lower=False)
        words = np.bincount(rows, minlength=n)
        ends = np.concatenate(([0], np.cumsum(words)))
        out = {c: np.zeros(n, np.int64) for c in COUNTS}
        out["n_words"], out["n_bytes"] = words, offsets[1:] - offsets[:-1]
        out["word_chars"] = _per_row(~common._SPACE[data] & ((data & 0xC0) != 0x80), offsets)
        out["n_symbols"], out["n_upper"] = _per_row(_SYMBOL[data], offsets), _per_row(_UPPER[data], offsets)
        threes = common.windows(h, 3)
        for i in range(n):
            if not words[i]:
                continue
            own = h[ends[i]:ends[i + 1]]
            lines = [x for x in data[offsets[i]:offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
            out["n_lines"][i], out["n_dup_lines"][i] = len(lines), len(lines) - len(set(lines))
            out["n_distinct"][i] = len(np.unique(own))
            out["n_doubled"][i] = int((own[1:] == own[:-1]).sum())
            if words[i] >= 3:
                _, which, times = np.unique(threes[ends[i]:ends[i + 1] - 2], return_inverse=True,
                                            return_counts=True)
                # A repeated window covers its own word and the next two.
                first = np.concatenate((times[which] > 1, [False, False]))
                again = first.copy()
                again[1:] |= first[:-1]
                again[2:] |= first[:-2]
                out["n_repeat_words"][i] = int(again.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(out[c], pa.int64()) for c in COUNTS)], names=["doc_id", *COUNTS])


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counted, f"doc_id long, {STATISTICS}")


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    limit: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.limit if self.above else x[self.feature] <= self.limit

    def column(self) -> Column:
        value, limit = F.expr(FEATURES[self.feature]), F.lit(float(self.limit))
        return value >= limit if self.above else value <= limit

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.limit:g}"


Rule = tuple[Term, ...]


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for term in rule:
        out &= term.holds(x)
    return out


def _best_term(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Term | None]:
    """The threshold of greatest gain: covered bad rows times the bits their share improves by."""
    p, n = int(bad.sum()), int((~bad).sum())
    base, best = np.log2(p / (p + n)), (1e-9, None)
    for name, values in x.items():
        order = np.argsort(values, kind="stable")
        v, b = values[order], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        for above in (False, True):
            got = np.cumsum(b)[cut] if not above else p - np.cumsum(b)[cut]
            size = cut + 1 if not above else len(v) - cut - 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(got > 0, got * (np.log2(got / size) - base), 0)
            if len(gain) and gain.max() > best[0]:
                k = cut[int(gain.argmax())]
                best = (float(gain.max()), Term(name, above, float((v[k] + v[k + 1]) / 2)))
    return best


def _take(x: dict[str, np.ndarray], mask: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[mask] for k, v in x.items()}


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = SEED) -> list[Rule]:
    """An ordered list of rules, each of which a text of poor quality meets."""
    draw, rules, failed = np.random.default_rng(seed), [], 0
    while bad.sum() >= 10 and len(rules) < MOST_RULES and failed < MOST_TRIES:
        grow = draw.random(len(bad)) < 2 / 3
        gx, gb, px, pb = _take(x, grow), bad[grow], _take(x, ~grow), bad[~grow]
        rule: Rule = ()
        while gb.any() and not gb.all() and len(rule) < MOST_TERMS:
            _, term = _best_term(gx, gb)
            if term is None:
                break
            rule += (term,)
            inside = term.holds(gx)
            gx, gb = _take(gx, inside), gb[inside]

        def worth(r: Rule) -> float:
            hit = _covered(r, px, len(pb))
            p, n = int(pb[hit].sum()), int((~pb[hit]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule or worth(rule) < 2 * LEAST_PRECISION - 1:
            failed += 1  # another draw of the rows may do better
            continue
        failed = 0
        rules.append(rule)
        rest = ~_covered(rule, x, len(bad))
        x, bad = _take(x, rest), bad[rest]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule holds; rules are tried in order."""
    out = F
    for rule in rules:
        condition = rule[0].column()
        for term in rule[1:]:
            condition &= term.column()
        out = out.when(condition, F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def rules_from(counted: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> list[Rule]:
    """Learn from at most ``per_label`` rows of each label; these come to the driver."""
    sample = common.bounded_sample(common.clear_labels(labels, "quality"), per_label, SEED)
    rows = (counted.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
            .select("doc_id", "label", *(F.expr(e).alias(k) for k, e in FEATURES.items()))
            .orderBy("doc_id").toArrow())
    bad = rows["label"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn({k: rows[k].to_numpy().astype(float) for k in FEATURES}, bad)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of every row, base_failed and kept."""
    counted = common.stored(statistics(documents), "statistics")
    rules = rules_from(counted, labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words"))
    return counted.select("doc_id", *COUNTS[:5], failed.alias("base_failed"),
                          (~failed & verdict(rules)).alias("kept"))
