"""Vector codes by Orchard's search against plain loops."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from compare import difference
from tillwise.llm import oracle, orchard, queries


def squares(points, entries):
    return ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)


@pytest.mark.parametrize("spread, entries", [(1, 256), (3000, 256), (40, 7), (5, 1)])
def test_search_finds_the_nearest_entry_and_ties_go_to_the_lower(spread, entries):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-4000, 4000, (12, 5))
    book = centres[rng.integers(0, 12, entries)] + rng.integers(-spread, spread + 1, (entries, 5))
    points = centres[rng.integers(0, 12, 3000)] + rng.integers(-spread, spread + 1, (3000, 5))
    found, distance = orchard.Codebook(book).nearest(points)
    plain = squares(points, book)
    assert (found == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def test_search_of_far_clusters_does_not_look_at_all_entries(monkeypatch):
    rng = np.random.default_rng(5)
    centres = np.arange(16)[:, None] * 100_000 + np.zeros((1, 4), np.int64)
    book = np.repeat(centres, 16, axis=0) + rng.integers(0, 50, (256, 4))
    looked = []
    plain = orchard.Codebook._squares
    searched = orchard.Codebook(book)
    monkeypatch.setattr(orchard, "STEP", 8)
    monkeypatch.setattr(orchard.Codebook, "_squares", lambda self, kind, p, e: (looked.append(len(p) * len(e)), plain(self, kind, p, e))[1])
    points = centres[rng.integers(0, 16, 500)] + rng.integers(0, 50, (500, 4))
    found, _ = searched.nearest(points)
    assert (found == squares(points, book).argmin(axis=1)).all()
    assert sum(looked) < 500 * 256 / 3


def test_large_components_are_exact_and_too_large_ones_told():
    book = np.array([[0, 0], [1 << 28, 1], [1 << 28, 2]])
    found, distance = orchard.Codebook(book).nearest(np.array([[(1 << 28) - 1, 2], [1, 1]]))
    assert found.tolist() == [2, 0] and distance.tolist() == [1, 2]
    with pytest.raises(OverflowError):
        orchard.Codebook(book * 8)


def plain_codes(rows):
    """The contract's steps one by one, in integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // 4
    cut = [[v[p * width:(p + 1) * width] for p in range(4)] for _, _, v in kept]
    firsts = {}
    for (i, _, v), parts in zip(kept, cut):
        key = (i is None, i or 0)
        if key not in firsts or v < firsts[key][0]:
            firsts[key] = (v, parts)
    books = [[firsts[k][1][p] for k in sorted(firsts)[:256]] for p in range(4)]

    def best(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(4):
        for p in range(4):
            members = defaultdict(list)
            for parts in cut:
                members[best(p, parts[p])[1]].append(parts[p])
            for k, parts in members.items():
                books[p][k] = [sum(x) // len(parts) for x in zip(*parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for (i, label, _), parts in zip(kept, cut):
        found = [best(p, parts[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, v int"


def codes(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = orchard.compress(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_codes_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8).round(1)], None if i % 7 == 0 else int(i % 3))
            for i in rng.permutation(420)]
    rows += [(500, None, 1), (501, [1.0] * 7 + [None], 1), (502, [1.0] * 7 + [float("nan")], 1),
             (503, [float("inf")] + [0.0] * 7, None), (504, [0.0] * 8, 0), (7, rows[3][1], 2), (7, rows[3][1], 2),
             (None, [0.25] * 8, 1), (None, [-0.25] * 8, None), (-3, [-1e-9] * 8, 5)]
    expected = plain_codes(rows)
    # Of another length than most, or not to be split: no part.
    assert codes(spark, rows + [(600, [1.0] * 4, 1), (601, [1.0] * 5, 1), (602, [], 1)]) == expected


def test_few_vectors_and_none(spark):
    rows = [(3, [1.0, 2.0, 3.0, 4.0], None), (1, [1.0, 2.0, 3.0, 4.0], None), (2, [5.0, 2.0, 3.0, 4.0], 1)]
    assert codes(spark, rows) == plain_codes(rows)
    assert codes(spark, []) == [] and codes(spark, [(1, None, 1), (2, [], 1)]) == []


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert not difference(queries.op11_orchard_codes(spark, folder), folder, oracle.STATEMENTS["op11_orchard_codes"])
