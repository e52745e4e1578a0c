"""Rotated codes against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import common, rotated_codes


def brute(rows, k=10):
    rows = list({(i, tuple(v)) for i, v in rows})
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    out = []
    for q, v in rows:
        if q % 100:
            continue
        d = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
        keep = ids != q
        for rank, j in enumerate(np.lexsort((ids[keep], d[keep]))[:k], 1):
            out.append((q, rank, int(ids[keep][j]), d[keep][j]))
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    return sorted(map(tuple, rotated_codes.search(df, F.col("vec_id") % 100 == 0, k).collect()))


def same(got, wanted):
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=1e-12)


def floats(x):
    return [float(np.float32(v)) for v in x]


@pytest.mark.parametrize("blocks", [(1024, 16_384), (2, 70)])
def test_equal_to_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(rotated_codes, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(rotated_codes, "CODE_BLOCK", blocks[1])
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 24)) + rng.standard_normal(24) * 3
    x[100:160] = x[7]  # ties
    rows = [(i, floats(v)) for i, v in enumerate(x)]
    same(run(spark, rows + rows[:50]), brute(rows))


def test_odd_vectors_take_no_part(spark):
    good = [(100, [1.0, 0.0, 0.0]), (1, [0.5, 0.5, 0.0]), (2, [0.0, 0.0, 9.0])]
    odd = [(3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [1.0, float("nan"), 0.0]),
           (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (200, [0.0, 0.0, 0.0])]
    same(run(spark, good + odd), brute(good))


def test_few_or_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0, 2.0])]) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])]) == []


def test_recall_on_the_given_table(spark):
    table = common.table(common.prepare(spark), "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in table.collect()]
    got = rotated_codes.search(table, F.col("vec_id") % 100 == 0)
    same(sorted(map(tuple, got.collect())), brute(rows))


def test_one_vector_of_many_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 16))
    x[::3] = x[0]  # a third of the rows, and of the queries
    rows = [(i, floats(v)) for i, v in enumerate(x)]
    same(run(spark, rows), brute(rows))
    classes = rotated_codes.classes_of(rotated_codes.marked(rotated_codes.usable(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>"))), 11).collect()
    assert len(classes) == 601 and sorted(len(r["ids"]) for r in classes)[-2:] == [1, 11]


def test_one_id_with_different_vectors(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [5.0, 5.0])]
    got = run(spark, rows, 3)
    assert [g[2] for g in got] == [1, 1, 100]
    assert [g[3] for g in got] == pytest.approx([0.1, np.hypot(1, 0.9), np.sqrt(2)], abs=1e-6)


def test_whole_vectors_move_for_few(spark, monkeypatch):
    kept = {}
    stored = common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    x = np.random.default_rng(9).standard_normal((6000, 64))
    rows = [(i, floats(v)) for i, v in enumerate(x)]
    same(run(spark, rows), brute(rows))
    assert kept["candidates"].count() < 0.03 * 60 * 6000
    assert kept["codes"].columns == ["class", "bits", "length", "own"]


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((3000, 64)), rng.standard_normal((20, 64))
    centre, turn = x.mean(axis=0), rotated_codes.rotation(64)
    guess, least = rotated_codes.bounds(q, *rotated_codes.encode(x, centre, turn), centre, turn)
    exact = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    assert (least <= exact + 1e-9).mean() > 0.9999
    assert np.abs(guess - exact).mean() < 0.5 * exact.std() + 10
    # The bounds do choose: most vectors are not fetched for the nearest ones.
    assert (least <= np.sort(exact, axis=1)[:, 9:10]).mean() < 0.05
