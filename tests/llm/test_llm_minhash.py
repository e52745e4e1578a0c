"""Near duplicates against all pairs of whole shingle sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillwise.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=4):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width=4):
    """(n_shingles, component_id, kept) per row; rows of one id are one document."""
    rows = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in rows:
        for b, t in rows:
            if a is None or b is None or a <= b or not s or not t:
                continue
            if 100 * len(s & t) >= 80 * len(s | t):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), i if i is None else top(i), i is None or top(i) == i) for i, s in rows), key=str)


def run(spark, rows, extra=""):
    schema = "doc_id long, text string, rep string, component long, lang string"
    df = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], schema)
    return sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)


def edited(rng, words, share):
    return [rng.choice("pqrstuvwxyz") + str(rng.randrange(10 ** 6)) if rng.random() < share else w for w in words]


def test_edges_of_the_definition(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b c"), (7, "A  B\nC"), (8, "a b c d"),
            (None, "a b c d"), (None, None), (9, " ".join(base)), (9, " ".join(base)), (10, " ".join(base).upper()),
            (11, " ".join(base) * 2), (12, "one text under two"), (12, "a b c d"), (13, "one text under two"),
            (14, "x" * 200_000), (15, "x" * 200_000 + " "), (16, "a b c d a b c d")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_families_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        base = [f"{rng.choice('abcdefg')}{rng.randrange(5000)}" for _ in range(rng.choice((5, 20, 120)))]
        for _ in range(rng.choice((1, 2, 6))):
            rows.append((n, " ".join(edited(rng, base, rng.choice((0, 0, 0.01, 0.04, 0.06))))))
            n += 1
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_large_group_with_stragglers(spark, monkeypatch):
    """A family wider than the threshold, in blocks smaller than the family."""
    monkeypatch.setattr(minhash, "LEFT_BLOCK", 8)
    monkeypatch.setattr(minhash, "RIGHT_BLOCK", 16)
    rng = random.Random(7)
    base = [f"v{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, rng.choice((0.005, 0.02, 0.035))))) for i in range(150)]
    expected = brute(rows)
    assert 1 < len({c for _, _, c, _ in expected}) < 150
    assert run(spark, rows) == expected


def test_intersections_by_incidence():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(20)]
    found = minhash._common(sets[:8], sets[8:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[8:]] for a in sets[:8]]


def _rows(sets, side):
    """Rows of one block, each its own component."""
    at = len(sets)
    least = [minhash.minima(s) for s in sets]
    node = pa.array([k + 1 for k in range(at)], pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([7] * at, pa.int64()), pa.array([0] * at, pa.int64()), pa.array([0] * at, pa.int64()),
         pa.array([side] * at, pa.int32()), node, node, pa.array([s.tobytes() for s in sets], pa.binary()),
         pa.array([(x >> np.uint32(24) ^ x & np.uint32(255)).astype(np.uint8).tobytes() for x in least], pa.binary())],
        names=["bucket", "l", "r", "side", "node", "component", "shingles", "minima"])


def test_links_of_a_large_group_are_a_forest():
    """Two groups of near copies: all pairs of a group are links, and one fewer than its members come out."""
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(2):
        base = np.unique(draw.integers(0, 1 << 63, 400, np.uint64))
        sets += [np.sort(np.delete(base, k)) for k in range(60)]
    out = list(minhash._cross_links(iter([_rows(sets, 0), _rows(sets, 1)])))
    links = [(a, b) for part in out for a, b in zip(part["a"].to_pylist(), part["b"].to_pylist())]
    assert len(links) == 2 * (60 - 1)
    above = {k: k for k in range(1, 121)}
    for _ in range(120):
        for a, b in links:
            above[a] = above[b] = min(above[a], above[b])
    assert [above[k] for k in range(1, 121)] == [1] * 60 + [61] * 60
