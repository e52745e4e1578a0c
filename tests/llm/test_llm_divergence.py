"""Divergence of sources against plain counting, and the transducers of its vocabulary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import difference
from tillwise.llm import divergence, oracle, queries

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def test_terms_of_a_text(monkeypatch):
    rng = random.Random(1)
    texts = ["", "A-b É9é ΣA日本ß_x’y", "\u0085a\x00b", "one" * 50] + [
        "".join(rng.choice("aBé .,'!\n0#Σ日") for _ in range(90)) for _ in range(100)]
    for part in (divergence.PART, 7):
        monkeypatch.setattr(divergence, "PART", part)
        for text in texts:
            found = [t.decode() for terms in divergence.terms_of(text.encode()) for t in terms]
            assert found == TERM.findall(text.translate(LOWER))


def right_languages(keys):
    """What may follow each beginning of a key: a minimal automaton has one state for each."""
    follows = defaultdict(set)
    for key in keys:
        for i in range(len(key) + 1):
            follows[key[:i]].add(key[i:])
    return len({frozenset(f) for f in follows.values()})


@pytest.mark.parametrize("seed", range(6))
def test_transducer_is_minimal_and_gives_ordinals(seed):
    rng = random.Random(seed)
    terms = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(150)})
    keys = [b"x\0" + t for t in terms] + [b"y\0a"]
    built = divergence.Transducer.load(divergence.Transducer.build(iter(keys)).dump())
    assert len(built.final) == right_languages(keys)
    asked = terms + [b"zz", b"a" * 9, b"ab\xc3"]
    rng.shuffle(asked)
    got = built.ordinals(b"x\0", b" ".join(asked))
    assert got.tolist() == [terms.index(t) if t in terms else -1 for t in asked]
    assert built.ordinals(b"y\0", b"a b").tolist() == [len(terms), -1]
    assert built.ordinals(b"z\0", b"a b").tolist() == [-1, -1]


def test_shares_are_exact_for_large_counts(spark):
    rng = random.Random(2)
    rows = [(0, 1), (1, 1), (7, 9 * 10 ** 14)]
    rows += [(n, n + rng.randint(0, 10 ** 12)) for n in (rng.randint(0, 10 ** rng.randint(1, 15)) for _ in range(50))]
    df = spark.createDataFrame(rows, "x long, m long")
    expected = [1 + 10 ** 9 * x // m for x, m in rows]
    assert [r.p for r in df.selectExpr(f"{divergence._billionths('x', 'm')} AS p").collect()] == expected
    x, m = np.array(rows, np.int64).T
    assert divergence.billionths(x, m).tolist() == expected


def plain_audit(rows, least):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [(s, c) for la, s, c in docs if la == lang]
        df = Counter(t for _, c in mine for t in c)
        kept = [t for t, n in df.items() if n >= least]
        counts = defaultdict(Counter)
        for s, c in mine:
            counts[s].update({t: c[t] for t in kept if c[t]})
        whole = sum(counts.values(), Counter())

        def p(c):
            m = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // m for t in kept}

        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            pair = [(sum(f(shares[s][t], shares[o][t]) for t in kept), o) for o in counts if o != s]
            term = [(f(shares[s][t], q[t]), t) for t in kept if counts[s][t] and shares[s][t] > q[t]]
            for part, items, top in (("pair", pair, None), ("term", term, 10)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(items[:top], 1)]
    return sorted(out)


SCHEMA = "text string, lang string, source string, ordinal int, n int, base int, run int"


def audited(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, divergence.audit(df, **more).collect()))


def made(seed, n, words, sources, langs=("en", "de", None, "a\0b", "a\1", "a")):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcÉé日") for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return [(None if rng.random() < 0.05 else rng.choice(" .\n-").join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))),
             rng.choice(langs), rng.choice(sources)) for _ in range(n)]


def test_audit_against_plain_counting(spark):
    rows = made(1, 400, 120, ("s1", "s2", "Σ", "a", None, ""))
    rows += rows[:30]  # repeated rows count again
    rows += [("only", "lone", "one"), (None, "lone", "two"), ("x " * 100_000, "en", "s1"), ("1234 --", "void", "one")]
    assert audited(spark, rows) == plain_audit(rows, 10)


def test_ties_go_to_the_smaller_term_and_source(spark):
    rows = [("b a ab é zz", "en", f"s{i % 3}") for i in range(30)] + [("b b a a ab ab é é zz", "en", "more")] * 2
    got = audited(spark, rows)
    assert got == plain_audit(rows, 10)
    assert [r[3] for r in got if r[1] == "more" and r[2] == "term"][:4] == ["a", "ab", "b", "é"]


def test_many_transducers_and_messages(spark):
    rows = made(7, 300, 150, ("s1", "s2", "s3"))
    df = spark.createDataFrame(rows, "text string, lang string, source string").na.fill("")
    kept = divergence.kept_terms(df, 3)
    runs, terms = divergence.vocabulary(kept, most=7)
    assert runs.count() > 20
    in_order = sorted((divergence.key_prefix(r.lang) + r.term.encode(), r.ordinal) for r in terms.collect())
    assert [n for _, n in in_order] == list(range(len(in_order)))
    got = {(r.lang, r.source, r.term): r.n for r in divergence.recount(df, runs, message=9).join(terms, ["lang", "ordinal"]).collect()}
    known = {(r.lang, r.term) for r in terms.collect()}
    expected = Counter()
    for text, lang, source in rows:
        expected.update((lang or "", source or "", t) for t in TERM.findall((text or "").translate(LOWER)))
    assert got == {k: n for k, n in expected.items() if (k[0], k[2]) in known}


def test_blocks_of_terms_add_up(spark, monkeypatch):
    rows = made(9, 200, 90, ("s1", "s2", "s3", "s4"), ("en",))
    monkeypatch.setattr(divergence, "CELLS", 12)  # three terms a block
    assert audited(spark, rows) == plain_audit(rows, 10)


def test_empty_table_and_no_kept_term(spark):
    assert audited(spark, []) == []
    rows = [("a", "en", "s1"), ("b", "en", "s2")]
    assert audited(spark, rows) == [("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)]


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert not difference(queries.op13_source_divergence(spark, folder), folder, oracle.STATEMENTS["op13_source_divergence"])
