"""Context mixing over token codes, held against a plain version that takes one bit at a time."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import lm_scoring, mixing

M64 = (1 << 64) - 1
TEXTS = ["the cat saw the cat on the mat", "a dog saw the mat", "", "The  dog\nsaw a cat\x0bon a rare-word mat", "zz zz"]


def book(texts: list[str]) -> mixing.Code:
    counts = collections.Counter(w for t in texts for w in [*t.encode().lower().split(), b""])
    often = sorted(w for w, c in counts.items() if c > 1)
    return mixing.Code(often, [counts[w] for w in often], 1 + sum(c for c in counts.values() if c == 1))


def slot_of(number: int, context: int, node: int, slot_bits: int) -> int:
    h = (((context * int(mixing._B) + number) & M64) ^ (context >> 29)) * int(mixing._A) & M64
    h ^= h >> 32
    return ((h + node * int(mixing._B) & M64) * int(mixing._C) & M64) >> (64 - slot_bits)


def plain_bits(code: mixing.Code, text: str, slot_bits: int):
    """Each bit of a text: slots, bit, level and bit of the guess, depth."""
    at = {w: i for i, w in enumerate(code.names)}
    ids = [at.get(w, code.escape) for w in [*text.encode().lower().split(), b""]]
    kind, none = code.kind(np.array(ids)), code.escape + 1
    for t, i in enumerate(ids):
        one = ids[t - 1] if t > 0 else none
        two = ids[t - 2] if t > 1 else none
        guess, level = None, 0
        for s in range(t - 1, -1, -1):
            if (ids[s - 1] if s > 0 else none) == one:
                guess, level = ids[s], 1 + ((ids[s - 2] if s > 1 else none) == two)
                break
        bits = format(code.code[i], "b").zfill(code.length[i]) if code.length[i] else ""
        guessed = format(code.code[guess], "b").zfill(code.length[guess]) if guess is not None else ""
        for depth, bit in enumerate(bits):
            node = int("1" + bits[:depth], 2)
            holds = len(guessed) > depth and guessed[:depth] == bits[:depth]
            slots = [slot_of(n + 1, c, node, slot_bits) for n, c in enumerate([0, kind, one, two * (none + 1) + one])]
            yield slots, int(bit), level if holds else 0, int(guessed[depth]) if holds else 0, depth


def plain_log10(mixer: mixing.Mixer, text: str) -> float:
    total = 0.0
    share = mixer.refiner.ones / mixer.refiner.all
    for slots, bit, level, guess, depth in plain_bits(mixer.code, text, mixer.slot_bits):
        pairs = [divmod(int(mixer.table[i, s]), 256) for i, s in enumerate(slots)]
        x = [math.log(one + mixing.PRIOR) - math.log(zero + mixing.PRIOR) for zero, one in pairs]
        x.append((2 * guess - 1) * mixing.GUESS if level else 0.0)
        sure = sum(sum(pairs[-1]) >= n for n in (1, 2, 4))
        gate = (sure * mixing.LEVELS + level) * mixing.DEPTHS + min(depth, mixing.DEPTHS - 1)
        mixed = sum(w * v for w, v in zip(mixer.weights[:, gate], x))
        place = min(max(mixed * 2 + mixing.MAP_CELLS // 2, 0), mixing.MAP_CELLS - 1.001)
        low, part = int(place), place - int(place)
        cell = gate * mixing.MAP_CELLS + low
        p = (1 / (1 + math.exp(-mixed)) + share[cell] * (1 - part) + share[cell + 1] * part) / 2
        total += math.log10(p if bit else 1 - p)
    return total


def trained(spark, texts: list[str]) -> mixing.Mixer:
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tokens = sum(len(t.split()) + 1 for t in texts)
    return mixing.train(docs, book(texts), tokens, docs)


def test_code_is_a_prefix_code_near_the_shares():
    draw = random.Random(3)
    counts = [draw.randint(1, 10 ** draw.randint(0, 14)) for _ in range(400)]
    code = mixing.Code([b"%d" % i for i in range(399)], counts[:399], counts[399])
    bits = sorted(format(c, "b").zfill(n) for c, n in zip(code.code.tolist(), code.length.tolist()))
    assert all(not b.startswith(a) for a, b in zip(bits, bits[1:]))
    for c, n in zip(counts, code.length):
        assert 0 <= n + math.log2(c / sum(counts)) < 1 + 1e-9


def test_table_counts_every_token(spark):
    mixer = trained(spark, TEXTS * 40)
    zeros, ones = collections.Counter(), collections.Counter()
    for text in TEXTS * 40:
        for slots, bit, _, _, _ in plain_bits(mixer.code, text, mixer.slot_bits):
            for i, s in enumerate(slots):
                (ones if bit else zeros)[i, s] += 1
    want = np.zeros_like(mixer.table)
    for i, s in zeros.keys() | ones.keys():
        want[i, s] = mixing.pairs_of(np.array([zeros[i, s]]), np.array([ones[i, s]]))[0]
    assert (mixer.table == want).all()


@pytest.mark.parametrize("slice_", [3, 1 << 16])
def test_scores_equal_the_plain_version(spark, monkeypatch, slice_):
    monkeypatch.setattr(mixing, "SLICE", slice_)
    mixer = trained(spark, TEXTS * 40)
    texts = [*TEXTS, "the mat saw the mat saw the mat", "unknown words only"]
    got = mixer.log10(mixer.code.read([t.encode() for t in texts]))
    assert got == pytest.approx([plain_log10(mixer, t) for t in texts], rel=1e-4)


def test_next_tokens_are_a_distribution(spark):
    """All tokens that could stand in a place, the escape among them, have at most probability 1 together."""
    mixer = trained(spark, TEXTS * 40)
    code = mixer.code
    before = [code.names.index(b"the"), code.names.index(b"cat")]
    many = code.escape + 1
    ids = np.array([[*before, i] for i in range(many)]).ravel()
    three = np.full(many, 3)
    found = mixing.Tokens(ids, np.repeat(np.arange(many), 3), np.ones(many, np.int64), three, three, [])
    two = mixing.Tokens(np.array(before), np.zeros(2, np.int64), np.ones(1, np.int64), np.array([2]), np.array([7]), [])
    each = 10 ** (mixer.log10(found) - mixer.log10(two)[0])
    assert 0.5 < each.sum() <= 1 + 1e-6


def test_whole_scores_of_a_small_corpus(spark, monkeypatch):
    """The score of a text is its codes, its words without a code, and its kind."""
    texts = TEXTS * 40 + ["unusual" + str(i) for i in range(9)]
    docs = spark.createDataFrame([*enumerate(texts), (1000, "the cat newword newword unusual3"), (1001, None)], "doc_id long, text string")
    made = {}
    for module, name in ((mixing, "train"), (lm_scoring, "train_speller")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name: made.setdefault(name, real(*a)))
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, F.col("doc_id") < 1000).collect()}
    counts = collections.Counter(w for t in texts for w in [*t.encode().lower().split(), b""])
    often = sorted(w for w, c in counts.items() if c > 1)
    other = {w: c for w, c in counts.items() if c == 1}
    assert len(other) == 9
    mixer, speller = made["train"], made["train_speller"]
    assert mixer.code.names == often
    p = {b"newword": 10 / 19 * 10 ** speller.log10([b"newword"])[0], b"unusual3": 1 / 19}
    ways = []
    for a in (None, *lm_scoring.STRENGTHS):
        before, product = collections.Counter(), 1.0
        for t, w in enumerate([b"newword", b"newword", b"unusual3"]):
            product *= p[w] if a is None else (a * p[w] + before[w]) / (a + t)
            before[w] += 1
        ways.append(product)
    mixed = plain_log10(mixer, "the cat newword newword unusual3")
    assert rows[1000]["score"] == pytest.approx(mixed + math.log10(sum(ways) / 4 / mixing.KINDS), rel=1e-3)
    assert rows[1001]["score"] == pytest.approx(plain_log10(mixer, "") - math.log10(mixing.KINDS), rel=1e-3)
    assert (rows[1000]["n_tokens"], rows[1000]["n_known"], rows[1001]["n_tokens"]) == (6, 4, 1)


def test_order_of_words_counts(spark):
    mixer = trained(spark, ["red green blue black white"] * 50 + ["white black blue green red"])
    seen, turned = mixer.log10(mixer.code.read([b"red green blue black white", b"white blue red black green"]))
    assert seen > turned + 2


def test_weights_are_learnt_on_all_training_texts_and_words(spark, monkeypatch):
    """Every bit of every training token leaves one unit in the map; the speller's of every distinct word."""
    docs = spark.createDataFrame([*enumerate(TEXTS * 40), (1000, "the cat held out")], "doc_id long, text string")
    made = {}
    for module, name in ((mixing, "train"), (lm_scoring, "train_speller")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name: made.setdefault(name, real(*a)))
    lm_scoring.score(docs, F.col("doc_id") < 1000).collect()
    mixer, speller = made["train"], made["train_speller"]
    bits = sum(1 for text in TEXTS * 40 for _ in plain_bits(mixer.code, text, mixer.slot_bits))
    assert mixer.refiner.all.sum() - mixing.Refiner(mixing.GATES).all.sum() == pytest.approx(bits, abs=1e-3)
    words = {w for t in TEXTS for w in [*t.encode().lower().split(), b""]}
    spelled = 8 * sum(len(w) + 1 for w in words)
    assert speller.refiner.all.sum() - mixing.Refiner(256).all.sum() == pytest.approx(spelled, abs=1e-3)


def test_guesses_agree_up_to_the_first_other_bit():
    draw = random.Random(5)
    pairs = [(draw.getrandbits(62), draw.getrandbits(draw.randint(1, 62))) for _ in range(500)]
    pairs += [(0, 0), (0, (1 << 61) - 1), (5, 5), (0, (1 << 55) - 1)]
    got = mixing.leading_equal(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert got.tolist() == [62 - (a ^ b).bit_length() for a, b in pairs]
