"""Decision lists, neighbours' votes and weak supervision: counts by brute force, accuracy on
held-out rows."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwise.llm import common, decisions, neighbours, toxicity

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n ", "a", "a b", "a b a b a b", "x y z x y z", "#*$ %&|<>\n#*$ %&|<>\n\n\n", "é 日本 é", "a\n a\na\n\t\na ",
       "w " * 100, " ".join(map(str, range(70))), "same line\n" * 60, "q" * 100_000]


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    threes = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if threes[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0, None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_words int, score string")


def test_counts_and_base_rules(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab #|\n") for _ in range(rng.randrange(200))) for _ in range(80)]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = decisions.judge(frame(spark, texts), labels).collect()
    assert len(got) == len(texts)
    for r in got:
        n = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert r.base_failed == failed and r.kept == (not failed)


def test_learnt_rules_read_as_conditions_and_hold_on_held_out_rows(spark):
    docs, labels = (common.table(common.prepare(spark), "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    counted = decisions.statistics(docs).cache()
    train = labels.where(common.crc_mod(4) != 2)
    rules = decisions.rules_from(counted, train)
    assert rules and all(str(t).count("=") == 1 for rule in rules for t in rule)
    judged = counted.select("doc_id", decisions.verdict(rules).alias("good"))
    held = judged.join(labels.where(common.crc_mod(4) == 2), "doc_id").where("doc_id is not null").collect()
    assert np.mean([r.good == bool(r.quality) for r in held]) > 0.98


def test_learning_finds_a_planted_rule():
    rng = np.random.default_rng(5)
    x = {k: rng.random(2000) for k in ("symbols_per_word", "upper_per_char", "words")}
    bad = (x["symbols_per_word"] > 0.7) & (x["words"] < 0.5) | (x["upper_per_char"] > 0.9)
    rules = decisions.learn(x, bad)
    hit = np.zeros(2000, bool)
    for rule in rules:
        hit |= decisions._covered(rule, x, 2000)
    assert (hit == bad).mean() > 0.97


def test_without_labels_of_both_kinds_there_are_no_rules(spark):
    counted = decisions.statistics(frame(spark, ODD))
    for rows in ([], [(1, 1), (2, 1)]):
        assert decisions.rules_from(counted, spark.createDataFrame(rows, "doc_id long, quality int")) == []


def accuracy(scored, labels, name):
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    return np.mean([r.predicted == r[name] for r in rows]), len(rows)


def test_neighbours_on_held_out_rows(spark):
    docs, labels = (common.table(common.prepare(spark), FOLDER, t) for t in ("documents", "labels"))
    scored = neighbours.quality(docs, labels).cache()
    assert scored.count() == docs.count()
    assert scored.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
    right, n = accuracy(scored, labels, "quality")
    assert n > 50 and right > 0.95


def test_neighbours_with_odd_texts_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = neighbours.quality(frame(spark, ODD), none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    docs = frame(spark, ODD + ["good plain words here"] * 3 + ["### $$$ %%% &&&"] * 3)
    labels = spark.createDataFrame([(14, 1), (15, 1), (16, 1), (17, 0), (18, 0), (19, 0)], "doc_id long, quality int")
    scores = [r.score for r in sorted(neighbours.quality(docs, labels).collect(), key=lambda r: r.doc_id)]
    assert all(0 <= s <= 1 for s in scores) and scores[14] > scores[17]


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(2)
    texts = pa.array(["".join(rng.choice(list("abc #$"), 60)) for _ in range(90)])
    counted = neighbours.term_counts(texts)
    space = neighbours.fit(counted[:60], rng.integers(0, 2, 60))
    got = space.scores(counted)
    x = space.project(counted)
    for i in range(90):
        cosine = x[i] @ space.vectors.T
        best = np.argsort(-cosine, kind="stable")[:neighbours.NEIGHBOURS]
        w = np.clip(cosine[best], 0, 1).astype(float) ** neighbours.SHARPNESS
        assert got[i] == pytest.approx((w * space.labels[best]).sum() / w.sum(), abs=1e-4)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (common.table(common.prepare(spark), "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    scored = toxicity.toxicity(docs, labels).cache()
    assert scored.count() == docs.count()
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01


def test_toxicity_of_odd_texts_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    texts = ODD + ["plain words about the sea and the sky"] * 20 + ["you stupid worthless idiot, moron"] * 5
    got = sorted(toxicity.toxicity(frame(spark, texts), none).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    assert got[-1].score > max(r.score for r in got[:-5])
    empty = toxicity.toxicity(frame(spark, []), none)
    assert empty.collect() == []


def test_label_model_learns_accuracies_from_votes_alone():
    rng = np.random.default_rng(8)
    y = rng.random(4000) < 0.2
    rates = [(0.6, 0.01), (0.5, 0.02), (0.4, 0.01), (0.3, 0.3)]
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # a voter that repeats another
    model = toxicity.label_model(votes)
    assert abs(model.prior - 0.2) < 0.08
    assert model.accuracies[:3].min() > 0.8 > model.accuracies[3]
    assert model.correlations[0, 4] > 0.95 and model.weights[0] == pytest.approx(0.5, abs=0.05)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.9


def test_patterns_stay_within_their_text():
    got = toxicity.patterns(pa.array(["so!", "?what", "WHY ME", "Nooo", "ooo no", "Sooooo", "a f*ck", "f**k", "*a* 2*3", None, ""]))
    names = [[n for n, x in zip(toxicity.PATTERNS, row) if x] for row in got]
    assert names == [["exclamation"], [], ["shouting"], [], [], ["letters drawn out"], ["masked word"], ["masked word"], [], [], []]
    assert toxicity.patterns(pa.array(["Go!? now and then and then and then and then and then and then"]))[0].tolist() == [False, False, True, False, False]
    assert toxicity.patterns(pa.array([], pa.string())).shape == (0, len(toxicity.PATTERNS))


def test_patterns_vote(spark):
    """The model reports accuracy and correlations of each pattern, and a text that only patterns mark is no clean one."""
    texts = (["plain words about the sea and the sky"] * 60 + ["you stupid worthless idiot, moron!!!! gooo awaaaay"] * 20
             + ["YOU STUPID IDIOT!!!!"] * 20 + ["LEAVE NOW AND NEVER COME BACK!!!!"] * 3)
    none = spark.createDataFrame([], "doc_id long, label int")
    classifier, model = toxicity.learn(frame(spark, texts), none)
    m = len(classifier.voters) + len(toxicity.PATTERNS)
    assert len(model.accuracies) == m and model.correlations.shape == (m, m)
    own = dict(zip(toxicity.PATTERNS, model.accuracies[-len(toxicity.PATTERNS):]))
    assert own["shouting"] > 0.8 and own["exclamation"] > 0.8 and own["letters drawn out"] > 0.8
    only = toxicity.all_votes(toxicity.word_marks(pa.array(texts[-1:])), toxicity.patterns(pa.array(texts[-1:])), classifier.voters)
    quiet = np.zeros_like(only)
    assert model.posterior(only)[0] > 0.5 > model.posterior(quiet)[0]
