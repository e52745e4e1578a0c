"""Budgets, the knapsack, and the mix of whole tables."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillwise.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Shares by weight; what is above twice the size is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    fixed, free, total = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > 2 * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * share for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
    return fixed


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, key int")
    return mixing.mix(df).collect()


def test_whole_mix_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randrange(0, 40)), rng.choice(["a", "a", "a", "b", "Z", "é", None, "", "c\U0001F600"]))
            for i in range(900)]
    rows += [(None, None, "a"), (None, "x y", None), (5, "", "b"), (7, "q " * 3000, "b"), (1000, "", "empty")]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    wanted, got = targets(sizes), run(spark, rows)
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        source = None if r.key == "n" else r.key[1:]
        assert r.source_size == sizes[source] and r.target == pytest.approx(wanted[source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= max(1, 0.001 * t), s


def test_reruns_agree(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 4}") for i in range(400)]
    first, again = (sorted((r.doc_id, r.taken) for r in run(spark, rows)) for _ in range(2))
    assert first == again


def test_one_length_only_and_empty_table(spark):
    got = run(spark, [(i, "a b c d", f"s{i % 2}") for i in range(300)])
    assert sum(r.taken for r in got) == pytest.approx(1.5 * 1200, abs=4)
    assert run(spark, []) == []
    assert [(r.target, r.taken) for r in run(spark, [(1, None, "a"), (2, "", None)])] == [(0.0, 0)] * 2


@pytest.mark.parametrize("seed", range(30))
def test_fit_is_as_near_as_can_be(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(mixing, "REMAINDER", 10_000)  # all of the budget is fitted
    lengths = np.sort(rng.choice(np.arange(1, 60), 6, replace=False)).astype(np.int64)
    counts = rng.integers(0, 4, 6).astype(np.int64)
    budget = int(rng.integers(0, (lengths * counts).sum() + 20))
    sums = {0}
    for n, c in zip(lengths.tolist(), counts.tolist()):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    got = mixing.fit(lengths, counts, budget)
    assert (got >= 0).all() and (got <= counts).all()
    assert abs(int((got * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_fit_of_a_large_budget(seed=3):
    rng = np.random.default_rng(seed)
    lengths = np.arange(1, 3001, dtype=np.int64)
    counts = rng.integers(1, 200, 3000).astype(np.int64)
    budget = int((lengths * counts).sum() * 0.37)
    got = mixing.fit(lengths, counts, budget)
    assert (got <= counts).all() and int((got * lengths).sum()) == budget
    assert np.corrcoef(got, counts)[0, 1] > 0.9  # in proportion, not all from one end
