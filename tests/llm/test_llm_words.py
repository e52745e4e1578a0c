"""Word hashing, components and the bounded samples."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tillwise.llm import common, components

TEXTS = ["", None, " ", "a", "a b a", "\x0bA\x0c b\rc\td\n", "été déjà", "x" * 3000, "日本 語 x"]


def _words(text, lower):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in found] if lower else found


@pytest.mark.parametrize("lower", [True, False])
@settings(deadline=None, max_examples=60)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t#日\x0b", max_size=40)), max_size=8))
def test_equal_hashes_are_equal_words(lower, texts):
    texts = texts + TEXTS
    h, rows = common.word_hashes(*common.text_bytes(pa.array(texts, pa.string())), lower)
    expected = [(i, w) for i, t in enumerate(texts) for w in _words(t, lower)]
    assert rows.tolist() == [i for i, _ in expected]
    known = {}
    for x, (_, w) in zip(h.tolist(), expected):
        assert known.setdefault(w, x) == x
    assert len(set(known.values())) == len(known)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(common, "_SLICE", 64)
    monkeypatch.setattr(common, "_cached", [])
    texts = ["lorem ipsum " * 50, "y" * 500, "", "a b " * 99]
    h, rows = common.word_hashes(*common.text_bytes(pa.array(texts)), False)
    assert np.bincount(rows, minlength=4).tolist() == [100, 1, 0, 198]
    assert len(set(h.tolist())) == 5


def test_sliced_columns_keep_their_rows():
    column = pa.array(["one", "two three", None, "four"]).slice(1, 3)
    data, offsets = common.text_bytes(column)
    assert data.tobytes() == b"two threefour" and offsets.tolist() == [0, 9, 9, 13]


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "a long, b long")


def _brute(rows):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in rows:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {x: top(x) for x in parent}


@pytest.mark.parametrize("rows", [
    [], [(1, 1)], [(None, 2), (3, None)], [(1, 2), (2, 1), (1, 2)],
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(5, 9), (9, 7), (7, 3), (20, 21), (21, 22), (3, 20), (50, 51)]])
def test_components_equal_union_find(spark, rows):
    found = components.components(_pairs(spark, rows), "a", "b").collect()
    assert {r.node: r.component for r in found} == _brute(rows)
    assert len(found) == len({r.node for r in found})


def test_labels_that_disagree_are_left_out(spark):
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1), (3, None), (None, 1), (4, 1), (5, 7)],
                                   "doc_id long, quality int")
    assert sorted(map(tuple, common.clear_labels(labels, "quality").collect())) == [(1, 0), (4, 1)]


def test_sample_is_bounded_and_repeats(spark):
    labels = spark.range(0, 500).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    first, again = (sorted(map(tuple, common.bounded_sample(labels, {0: 30, 1: 20}, 3).collect())) for _ in range(2))
    assert first == again and [sum(y == v for _, y in first) for v in (0, 1)] == [30, 20]
