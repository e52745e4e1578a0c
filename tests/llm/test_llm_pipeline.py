"""The pipeline's stages against plain versions of what they decide."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_llm_minhash import brute
from test_llm_mixing import size, targets
from test_llm_secrets import base

from tillwise.llm import neighbours, stages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _key int, n int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "x", 1, 2) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{k}" for k in range(400)]
    out = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.choice((3, 60, 200))))
        out.append((i, text, rng.choice(["a", "b", "b", "b", None])))
    out += [(200 + i, out[i][1] + " tail", "c") for i in range(0, 60, 3)]
    out += [(300, out[5][1], "a"), (5, out[5][1], out[5][2]), (6, "another text under one id", "b"), (None, None, None),
            (None, "no id at all", "b"), (400, "", "a"), (401, None, "b"), (402, "password = abcdefgh " + out[9][1], "b"),
            (403, "AKIA" + "Q" * 20, "c")]
    return out


def collected(df):
    assert df.columns == COLUMNS
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_near_duplicates_keep_one_of_each_group(spark, rows):
    """Rows are judged one by one: numbered in the order in which a group's first is chosen."""
    extra = [(5, rows[8][1] + " more words under an id of others", "a"), (None, "no id at all", "c"), (None, rows[5][1], "a"), (7, "", "a")]
    everything = rows + extra + extra[:1]
    got = collected(stages.near_duplicates(spark, docs(spark, everything), "unused"))
    ordered = sorted(everything, key=lambda r: (r[0] is None, r[0] or 0))
    groups = defaultdict(list)
    for k, _, group, _ in sorted(brute([(k, r[1]) for k, r in enumerate(ordered)], stages.WIDTH)):
        groups[group].append(ordered[k])
    assert len(got) == len(groups) and set(got) <= set(everything)
    left = Counter(got)
    # Groups of one are all there; of every other, one row of the smallest id.
    for held in sorted(groups.values(), key=len):
        least = [r for r in held if r[0] == held[0][0]]
        chosen = next(r for r in least if left[r])
        left[chosen] -= 1
    assert not +left


def test_mixing_takes_rows_of_one_id_one_by_one(spark):
    rows = [(i % 3 if i % 2 else None, " ".join(f"w{i}x{k}" for k in range(10 + i % 5)), "ab"[i % 2]) for i in range(400)]
    got = collected(stages.mixing(spark, docs(spark, rows), "unused"))
    taken = Counter()
    for _, t, s in got:
        taken[s] += size(t)
    totals = Counter()
    for _, t, s in rows:
        totals[s] += size(t)
    assert set(got) <= set(rows) and max(Counter(got).values()) <= 2
    for s, t in targets(totals).items():
        assert abs(taken[s] - t) <= max(3, 0.01 * t)
    again = collected(stages.mixing(spark, docs(spark, rows[::-1]).repartition(5), "unused"))
    assert Counter(got) == Counter(again)


def test_secrets_go_and_all_others_stay(spark, rows):
    got = collected(stages.secrets(spark, docs(spark, rows), "unused"))
    assert Counter(got) == Counter(r for r in rows if not base(r[1])[0])


def test_mixing_repeats_documents_up_to_twice(spark, rows):
    rows = list({r[0]: r for r in rows if r[0] is not None}.values())
    got = collected(stages.mixing(spark, docs(spark, rows), "unused"))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    for _, t, s in got:
        taken[s] += size(t)
    assert set(got) <= set(rows) and max(Counter(got).values()) <= 2
    for s, t in targets(sizes).items():
        assert abs(taken[s] - t) <= max(3, 0.01 * t)


def test_quality_follows_the_operator(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    scored = neighbours.quality(table, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = {r.doc_id for r in scored.where("predicted = 1").collect()}
    got = stages.quality(spark, table.withColumn("score", F.lit("clash")), folder)
    assert got.columns == COLUMNS and {r.doc_id for r in got.collect()} == kept
    assert 0.5 * table.count() < len(kept) < table.count()


def test_empty_documents_pass_every_stage(spark):
    docs_ = docs(spark, []).select(COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_, "/root/testdata/sf0.001").count() == 0


def test_whole_pipeline(spark):
    pytest.importorskip("public_tokenizers")
    folder = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert got and {r.doc_id for r in got} < ids
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 4096
    assert max(Counter((r.doc_id, r.piece) for r in got).values()) <= 2
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and re.match("doc_id", corpus_pipeline.run(spark, folder).columns[0])
