"""Tokens, pieces and sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillwise.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path(packing.TOKENIZER)

ODD = ["", "  ", "Ça l'été!! a'b don't I'LL x É é 日本語 123 4a5 ΣΑΣ İx b em ﬁ ª \x1cq a\u0085b ...!!! ß ÀÉ' 'tis x’s\n\tq",
       "<|startoftext|>hello<|endoftext|>!!!", "<|StartOfText|> A, B. c,. d.!, e.", "é É, a.́ x", "it's, It's. THE",
       "q" * 500 + " " + "ab,." * 90, "a.b.c, d.e", "x.　y, z"]


def plain():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    return lambda text: whole.encode(text, add_special_tokens=False).ids


def test_tokens_of_words_are_tokens_of_the_text():
    ids, words = plain(), packing.WordTokens(PATH)
    rng = random.Random(2)
    made = ["".join(rng.choice("aBé .,'!\n0#Σ日́<|>") for _ in range(60)) for _ in range(300)]
    for text in ODD + made:
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == ids(text), text


def test_pieces_and_sequences(spark):
    ids, rng = plain(), random.Random(3)
    texts = ODD + [None] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice((1, 30, 900, 5000, 9000)))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(3, ODD[3]), (3, ODD[3]), (None, "no id"), (900, "a " * 4095), (901, "a " * 4096)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, rank int")
    got = packing.pack(df, PATH).collect()
    expected = Counter()
    for i, text in rows:
        all_ids = np.array(ids(text or "") + [1], "<u4")
        for k, at in enumerate(range(0, len(all_ids), 4096)):
            part = all_ids[at:at + 4096]
            expected[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-sum(r.length for r in got) // 4096) + 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, PATH).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_configurations_hold_exactly_the_pieces(seed):
    rng = np.random.default_rng(seed)
    counts = {int(k): int(rng.integers(1, 50)) for k in rng.choice(np.arange(1, 101), rng.integers(1, 40), replace=False)}
    used = packing.configurations(dict(counts), capacity=100, rounds=60)
    held = Counter()
    for config, times in used:
        assert times > 0 and sum(k * n for k, n in config.items()) <= 100
        for k, n in config.items():
            held[k] += n * times
    assert held == counts
    assert sum(t for _, t in used) <= sum(t for _, t in packing.configurations(dict(counts), 100, rounds=0))


def test_three_thirds_fill_a_sequence():
    """Best fit alone would put two of the longer ones together first."""
    counts = {34: 600, 33: 1200}
    assert sum(t for _, t in packing.configurations(counts, 100, rounds=0)) > 690
    assert sum(t for _, t in packing.configurations(counts, 100)) <= 606


def test_fractional_cover_is_near_the_dual_bound():
    """Prices that no configuration exceeds bound every cover from below."""
    import numpy as np

    rng = np.random.default_rng(6)
    need = np.zeros(101)
    need[rng.choice(np.arange(5, 90), 12, replace=False)] = rng.integers(50, 300, 12)
    use = packing.fractional(need, 100, 400)
    covered = np.zeros(101)
    for config, times in use.items():
        for k, n in config:
            covered[k] += n * times
    some = need > 0
    scale = (covered[some] / need[some]).min()
    volume = (np.arange(101) * need).sum() / 100
    assert scale > 0.9 and sum(use.values()) / scale < 1.35 * volume


@pytest.mark.parametrize("most", [1, 60])
def test_many_lengths_are_all_covered_close_to_the_bound(most):
    """More lengths than rounds, scarce short ones among them."""
    rng = np.random.default_rng(most)
    need = np.zeros(2001)
    need[rng.choice(np.arange(5, 1200), 700, replace=False)] = rng.integers(1, most + 1, 700)
    need[5] = 1
    use = packing.fractional(need, 2000, 400)
    covered = np.zeros(2001)
    for config, times in use.items():
        assert sum(k * n for k, n in config) <= 2000
        for k, n in config:
            assert n <= need[k]
            covered[k] += n * times
    assert (covered == need).all()
    assert sum(use.values()) <= 1.02 * (np.arange(2001) * need).sum() / 2000 + 1


def test_bound_counts_what_volume_does_not():
    need = np.zeros(101)
    need[[51, 52, 10]] = 40, 60, 5
    use, bound = packing.cover(need, 100, 400)
    assert bound == pytest.approx(100) and sum(use.values()) == 100
