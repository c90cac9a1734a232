"""Logistic context mixing over the bits of token codes.

Tokens met often have a prefix code, the first bits of the share of tokens before them in
the order of falling count; one more symbol, the escape, stands for all others. A text is
the row of its tokens' codes, predicted bit by bit from the start of the text to its end.
Four predictors hash their context and the bits of the code so far into tables of counts
of zeros and ones, taken over every token of all training texts. Their contexts are: none,
the kind of the text, the token before, and the two tokens before. A fifth predicts the
token that followed the same token earlier in the text. Predictions meet in the logistic
domain with weights chosen by a gate: how much the longest context has been seen, how sure
the fifth predictor's place is, and how deep the bit lies. The result is refined by an
adaptive map from (gate, probability) to the observed share of ones.

Tables grow with the training tokens up to ``MOST_SLOT_BITS``, so that they fit beside a
worker; contexts that share a slot share its counts. Counts beyond 255 are scaled down.
Weights and map are learnt online, each bit left out of the counts while it is predicted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

CONTEXTS = 4
LEAST_SLOT_BITS, MOST_SLOT_BITS = 14, 21
KINDS, KIND_BYTES = 32, 3
CONFIDENCES, LEVELS, DEPTHS = 4, 3, 8
GATES = CONFIDENCES * LEVELS * DEPTHS
GUESS = 2.0
PRIOR = 0.4
STEP = 0.05
MAP_CELLS, MAP_START = 33, 20.0
# Tokens whose bits are predicted side by side, in scoring and while learning.
SLICE, LEARN_SLICE = 1 << 14, 1 << 14
# A worker's arrays for a piece of text take some fifty times its bytes, so pieces are small.
PIECE_BYTES = 1 << 20
# Codes stand at the upper end of so many bits.
CODE_BITS = 62
# Bits of a token whose probabilities are multiplied before their logarithm is taken.
PRODUCT_BITS = 16
# A task counts contexts of at least so many tokens, where the input has as many.
TASK_TOKENS = 1 << 20
# Counts travel in blocks of so many slots.
BLOCK = 1 << 10

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_C = np.uint64(0xBF58476D1CE4E5B9)

# Of a pair of counts: its prediction, and the place of its confidence among gates.
_PAIRS = np.arange(1 << 16)
_LOGIT = (np.log((_PAIRS & 255) + PRIOR) - np.log((_PAIRS >> 8) + PRIOR)).astype(np.float32)
_CONFIDENCE = (np.searchsorted([1, 2, 4], (_PAIRS & 255) + (_PAIRS >> 8), side="right") * LEVELS).astype(np.int8)
# The same with one count less of a zero (first half) or of a one, where there is one.
_LESS = np.r_[_PAIRS - 256 * (_PAIRS > 255), _PAIRS - ((_PAIRS & 255) > 0)]
_LOGIT_LESS, _CONFIDENCE_LESS = _LOGIT[_LESS], _CONFIDENCE[_LESS]


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


class Refiner:
    """Map from a state and the mixed probability to the observed share of ones."""

    def __init__(self, states: int) -> None:
        centre = squash((np.arange(MAP_CELLS) - MAP_CELLS // 2) / 2.0)
        self.ones = np.tile(centre * MAP_START, (states, 1)).ravel()
        self.all = np.full(states * MAP_CELLS, MAP_START)

    def cells(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.clip(x * 2 + MAP_CELLS // 2, 0, MAP_CELLS - 1.001)
        low = place.astype(np.int64)
        return state * MAP_CELLS + low, place - low

    def refine(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Mean of the mixed probability and the map's, between two cells."""
        low, part = self.cells(x, state)
        share = self.ones / self.all
        return (squash(x) + share[low] * (1 - part) + share[low + 1] * part) / 2

    def learn(self, x: np.ndarray, state: np.ndarray, bit: np.ndarray) -> None:
        if not len(x):
            return
        # Only the cells of the states there are.
        first, last = int(state.min()), int(state.max()) + 1
        low, part = self.cells(x, state - first)
        ones, all_ = (v[first * MAP_CELLS : last * MAP_CELLS] for v in (self.ones, self.all))
        for cell, weight in ((low, 1 - part), (low + 1, part)):
            ones += np.bincount(cell, weight * bit, len(ones))
            all_ += np.bincount(cell, weight, len(all_))


@dataclass
class Tokens:
    """Tokens of some texts in order, and what the texts hold besides."""

    ids: np.ndarray
    row: np.ndarray
    kind: np.ndarray
    total: np.ndarray
    sizes: np.ndarray
    others: list[Counter[bytes]]


class Code:
    """Prefix code of frequent tokens and of the escape, the last symbol."""

    def __init__(self, names: list[bytes], counts: list[int], escape: int) -> None:
        self.names = names
        self.escape = len(names)
        counts = [*counts, escape]
        total, before = sum(counts), 0
        self.code = np.zeros(len(counts), np.int64)
        self.length = np.zeros(len(counts), np.int64)
        for i in sorted(range(len(counts)), key=lambda i: (-counts[i], i)):
            # The least length whose unit is at most the share of the token.
            length = (-(-total // counts[i]) - 1).bit_length()
            self.code[i], self.length[i] = (before << length) // total, length
            before += counts[i]
        self.top = self.code << (CODE_BITS - self.length)
        self.short = np.array([0 < len(w) <= KIND_BYTES for w in names] + [False])
        self.hash = np.array([zlib.crc32(w) for w in names] + [0], np.int64)
        self.at: dict[bytes, int] | None = None

    def kinds(self, ids: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Numbers of the texts' kinds, from their most frequent short token; 0 without one."""
        out = np.zeros(len(total), np.int64)
        some = self.short[ids]
        row = np.repeat(np.arange(len(total)), total)[some]
        if not len(row):
            return out
        found, times = np.unique(row * len(self.short) + ids[some], return_counts=True)
        row, hashed = found // len(self.short), self.hash[found % len(self.short)]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        most = np.repeat(np.maximum.reduceat(times, first), np.diff(np.r_[first, len(row)]))
        least = np.minimum.reduceat(np.where(times == most, hashed, np.iinfo(np.int64).max), first)
        out[row[first]] = 1 + least % (KINDS - 1)
        return out

    def kind(self, ids: np.ndarray) -> int:
        """Number of one text's kind."""
        return int(self.kinds(ids, np.array([len(ids)]))[0])

    def read(self, texts: list[bytes], others: bool = True) -> Tokens:
        """Words of texts, lower-cased, and an end each; bytes splits at the six ASCII blanks.

        ``others`` asks for the words without a code, too.
        """
        if self.at is None:
            self.at = {w: i for i, w in enumerate(self.names)}
        get, escape = self.at.get, self.escape
        ids, left = [], []
        for body in texts:
            words = body.lower().split()
            words.append(b"")
            found = np.fromiter(map(get, words, repeat(escape)), np.int64, len(words))
            ids.append(found)
            if others:
                left.append(Counter([words[i] for i in np.flatnonzero(found == escape).tolist()]))
        total = np.array([len(x) for x in ids], np.int64)
        every = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        return Tokens(
            every, np.repeat(np.arange(len(ids)), total), self.kinds(every, total), total,
            np.array([len(t) for t in texts], np.int64), left,
        )

    def __getstate__(self):
        return {**self.__dict__, "at": None}


def contexts(code: Code, found: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: hashed contexts, the token guessed from its text, and how sure the guess's place is.

    Tokens before a text's start are none. Hashes are multiplied by ``_C`` already, as
    (hash + node * B) * C is hash * C + node * (B * C).
    """
    ids, row = found.ids, found.row
    none = code.escape + 1
    start = np.cumsum(found.total) - found.total
    one, two = np.full(len(ids), none), np.full(len(ids), none)
    one[1:] = ids[:-1]
    one[start] = none
    two[1:] = one[:-1]
    two[start] = none
    plain = np.stack([np.zeros(len(ids), np.int64), found.kind[row], one, two * (none + 1) + one])
    number = np.arange(1, CONTEXTS + 1, dtype=np.uint64)[:, None]
    hashed = plain.view(np.uint64)
    hashed = ((hashed * _B + number) ^ (hashed >> np.uint64(29))) * _A
    hashed ^= hashed >> np.uint64(32)
    hashed *= _C
    # Equal tokens before in the same text: the latest earlier place. Text, token and place
    # have fewer than 64 bits together, and numbers are sorted faster than places by key.
    bits = np.int64(len(ids).bit_length())
    packed = np.sort((row * (none + 1) + one) << bits | np.arange(len(ids)))
    order, key = packed & ((1 << bits) - 1), packed >> bits
    same = key[1:] == key[:-1]
    here, earlier = order[1:][same], order[:-1][same]
    guess, level = np.full(len(ids), code.escape), np.zeros(len(ids), np.int64)
    guess[here] = ids[earlier]
    level[here] = 1 + (two[here] == two[earlier])
    return hashed, guess, level


def leading_equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the ``CODE_BITS`` bits of two numbers are the same, from the upper end."""
    differ = a ^ b
    # No bit follows the first one, so no rounding reaches the next power of two.
    return CODE_BITS - np.frexp((differ & ~(differ >> 1)).astype(float))[1].astype(np.int64)


# How many tokens, from the first of a slice, have the bit; slots by predictor, bits, level
# and bit of the guess, depth.
Step = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]


def bit_steps(code: Code, found: Tokens, slot_bits: int, size: int) -> Iterator[tuple[np.ndarray, Iterator[Step]]]:
    """Slices of tokens: their places by falling length of the code, and their bits step by step."""
    every = contexts(code, found)
    shift = np.uint64(64 - slot_bits)
    node_factor = np.uint64(int(_B) * int(_C) % (1 << 64))

    def steps(length, top, guess_top, agree, level, hashed) -> Iterator[Step]:
        longest = int(length[0])
        alive = np.searchsorted(-length, -np.arange(longest), side="left").tolist()
        for depth, k in enumerate(alive):
            node = (top[:k] >> (CODE_BITS - depth)) | (1 << depth)
            slots = hashed[:, :k] + node.view(np.uint64) * node_factor
            slots >>= shift
            bit = (top[:k] >> (CODE_BITS - 1 - depth)) & 1
            guess = (guess_top[:k] >> (CODE_BITS - 1 - depth)) & 1
            # A guess counts while its code agrees.
            yield k, slots.view(np.int64), bit, level[:k] * (agree[:k] >= depth), guess, depth

    for a in range(0, len(found.ids), size):
        ids = found.ids[a : a + size]
        order = np.argsort(-code.length[ids].astype(np.int16), kind="stable")
        at, ids = a + order, ids[order]
        guess = every[1][at]
        top, guess_top = code.top[ids], code.top[guess]
        agree = np.minimum(leading_equal(top, guess_top), code.length[guess] - 1)
        hashed = np.stack([h[at] for h in every[0]])
        yield at, steps(code.length[ids], top, guess_top, agree, every[2][at], hashed)


@dataclass
class Mixer:
    """Code, tables of counts (zeros * 256 + ones), weights and map."""

    code: Code
    slot_bits: int
    table: np.ndarray
    weights: np.ndarray
    refiner: Refiner

    def __setstate__(self, state: dict) -> None:
        # Memory of its own has larger pages than that of a pickle, and is looked up faster.
        self.__dict__.update(state, table=state["table"].copy())

    def pairs(self, slots: np.ndarray) -> np.ndarray:
        out = np.empty(slots.shape, self.table.dtype)
        for row, at, into in zip(self.table, slots, out):
            np.take(row, at, out=into, mode="clip")
        return out

    def mixed(self, weights: np.ndarray, logits: np.ndarray, guessed: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Sum of predictions in the logistic domain, weighted by state, the gate at one depth."""
        out = np.take(weights[-1], state) * guessed
        for each, x in zip(weights, logits):
            out += np.take(each, state) * x
        return out

    def log10(self, found: Tokens) -> np.ndarray:
        """log10 probability of each text's codes."""
        out = np.zeros(len(found.total))
        weights = self.weights.astype(np.float32).reshape(CONTEXTS + 1, -1, DEPTHS)
        share = (self.refiner.ones / self.refiner.all).reshape(-1, DEPTHS, MAP_CELLS)
        # By depth and bit, of each state and cell: the share of the bit, and its rise to the next cell.
        share = np.stack([1 - share, share]).transpose(2, 0, 1, 3)
        rise = np.diff(share, append=share[..., -1:]).astype(np.float32).reshape(DEPTHS, -1)
        share = share.astype(np.float32).reshape(DEPTHS, -1)
        half = CONFIDENCES * LEVELS * MAP_CELLS
        for at, steps in bit_steps(self.code, found, self.slot_bits, SLICE):
            total, product = np.zeros(len(at)), np.ones(len(at))
            for k, slots, bit, level, guess, depth in steps:
                pairs, d = self.pairs(slots), min(depth, DEPTHS - 1)
                state = np.take(_CONFIDENCE, pairs[-1]) + level
                mixed = self.mixed(weights[:, :, d], np.take(_LOGIT, pairs), guessed(level, guess), state)
                place = np.clip(mixed * 2 + MAP_CELLS // 2, 0, np.float32(MAP_CELLS - 1.001))
                low = place.astype(np.int64)
                place -= low
                low += state * MAP_CELLS
                low += bit * half
                # The bit's own probability, so that small ones keep their digits.
                own = np.exp(np.clip(mixed * (1 - 2 * bit).astype(np.float32), -20, 20))
                p = np.float32(1) / (own + 1) + np.take(share[d], low) + place * np.take(rise[d], low)
                product[:k] *= p * np.float32(0.5)
                if depth % PRODUCT_BITS == PRODUCT_BITS - 1:
                    total[:k] += np.log10(product[:k])
                    product[:k] = 1
            out += np.bincount(found.row[at], total + np.log10(product), len(out))
        return out

    def learn(self, found: Tokens, slopes: np.ndarray) -> None:
        """One online pass over texts that are in the counts; each bit is left out while predicted."""
        states = CONFIDENCES * LEVELS
        shape = (CONTEXTS + 1, states, DEPTHS)
        every, every_slope = self.weights.reshape(shape), slopes.reshape(shape)
        ones = self.refiner.ones.reshape(states, DEPTHS, MAP_CELLS)
        all_ = self.refiner.all.reshape(states, DEPTHS, MAP_CELLS)
        for _, steps in bit_steps(self.code, found, self.slot_bits, LEARN_SLICE):
            for _, slots, bit, level, guess, depth in steps:
                pairs, d = self.pairs(slots) + (bit << 16), min(depth, DEPTHS - 1)
                x, last = np.take(_LOGIT_LESS, pairs), guessed(level, guess)
                state = np.take(_CONFIDENCE_LESS, pairs[-1]) + level
                weights = every[:, :, d]
                mixed = self.mixed(weights.astype(np.float32), x, last, state)
                missed = bit - squash(mixed)
                many = np.maximum(np.bincount(state, minlength=states), 1)
                slope = np.stack([np.bincount(state, missed * row, states) for row in (*x, last)]) / many
                every_slope[:, :, d] += slope * slope
                weights += STEP * slope / np.sqrt(every_slope[:, :, d])
                low, part = self.refiner.cells(mixed, state + bit * states)
                seen = np.bincount(low, 1 - part, 2 * states * MAP_CELLS)
                seen += np.bincount(low + 1, part, 2 * states * MAP_CELLS)
                seen = seen.reshape(2, states, MAP_CELLS)
                ones[:, d] += seen[1]
                all_[:, d] += seen[0] + seen[1]


def guessed(level: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Prediction of the token that followed earlier."""
    return ((level > 0) * (2 * guess - 1)).astype(np.float32) * np.float32(GUESS)


def start_weights() -> np.ndarray:
    return np.full((CONTEXTS + 1, GATES), 0.3)


def slot_bits_for(tokens: int) -> int:
    """Slots of a predictor: the power of two that reaches the training tokens, within the bounds."""
    return min(max(int(tokens).bit_length(), LEAST_SLOT_BITS), MOST_SLOT_BITS)


def pairs_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Both counts in 16 bits, scaled so that the larger is at most 255; a count stays above 0."""
    scale = np.maximum((np.maximum(zeros, ones) + 254) // 255, 1)
    return (-(-zeros // scale) * 256 + -(-ones // scale)).astype(np.uint16)


def count_contexts(docs: DataFrame, code: Callable[[], Code], tokens: int, slot_bits: int) -> np.ndarray:
    """Table of counts over every token of all texts.

    A task's counts leave it as packed blocks of slots, which are summed one by one where they meet;
    what comes to the driver is the table, of a fixed size.
    """
    slots_all = CONTEXTS << slot_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Zeros and ones of a slot side by side.
        seen = np.zeros(2 * slots_all, np.int32)
        base = (np.arange(CONTEXTS) << (slot_bits + 1))[:, None]
        for whole in batches:
            for batch in common.chunks(whole, "text", PIECE_BYTES):
                found = code().read(common.byte_texts(batch), others=False)
                for _, steps in bit_steps(code(), found, slot_bits, SLICE):
                    for _, slots, bit, _, _, _ in steps:
                        for at in (slots << 1) + (base + bit):
                            np.add.at(seen, at, np.int32(1))
        # Most counts are small: byte by byte, with the upper ones apart, a block packs well.
        blocks = seen.reshape(-1, 2 * BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        for a in range(0, len(some), 256):
            planes = (blocks[i].view(np.uint8).reshape(-1, 4).T.tobytes() for i in some[a : a + 256])
            packed = pa.array([pa.compress(p, "zstd", asbytes=True) for p in planes], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(some[a : a + 256].astype(np.int32)), packed], ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*(c.to_pylist() for c in batch.columns)):
                planes = np.frombuffer(pa.decompress(counts, 8 * BLOCK, "zstd"), np.uint8).reshape(4, -1)
                held = sums.setdefault(block, np.zeros((2, BLOCK), np.int64))
                held += np.ascontiguousarray(planes.T).view(np.int32).reshape(-1, 2).T
        pairs = [pairs_of(x[0], x[1]).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(pairs, pa.binary())], ["block", "pairs"])

    tasks = max(1, -(-tokens // TASK_TOKENS))
    found = docs.select("text").coalesce(tasks).mapInArrow(run, "block int, counts binary")
    sums = found.repartition("block").mapInArrow(total, "block int, pairs binary").toArrow()
    table = np.zeros(slots_all, np.uint16)
    for block, pairs in zip(sums.column(0).to_pylist(), sums.column(1).to_pylist()):
        table[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(pairs, np.uint16)
    return table.reshape(CONTEXTS, -1)


def train(docs: DataFrame, code: Code, tokens: int, learnt_from: DataFrame) -> Mixer:
    """Counts over all of ``docs``; weights and map from ``learnt_from``, averaged over its parts."""
    spark = docs.sparkSession
    slot_bits = slot_bits_for(tokens)
    table = count_contexts(docs, common.sent_to_workers(spark, code), tokens, slot_bits)
    shared = common.sent_to_workers(spark, Mixer(code, slot_bits, table, start_weights(), Refiner(GATES)))
    cells = GATES * MAP_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared()
        mixer = Mixer(given.code, slot_bits, given.table, start_weights(), Refiner(GATES))
        slopes, n = np.full((CONTEXTS + 1, GATES), 1e-4), 0
        for whole in batches:
            for batch in common.chunks(whole, "text", PIECE_BYTES):
                found = given.code.read(common.byte_texts(batch), others=False)
                mixer.learn(found, slopes)
                n += len(found.ids)
        start = Refiner(GATES)
        moved = [mixer.refiner.ones - start.ones, mixer.refiner.all - start.all]
        values = np.r_[mixer.weights.ravel() * n, *moved, n]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "value"])

    tasks = max(1, -(-tokens // TASK_TOKENS))
    learnt = learnt_from.select("text").coalesce(tasks).mapInArrow(run, "at int, value double")
    w = (CONTEXTS + 1) * GATES
    sums = np.zeros(w + 2 * cells + 1)
    # The same number of values from each part; as many rows in the end.
    for r in learnt.groupBy("at").agg(F.sum("value").alias("value")).collect():
        sums[r["at"]] = r["value"]
    weights = (sums[:w] / sums[-1]).reshape(CONTEXTS + 1, GATES) if sums[-1] else start_weights()
    refiner = Refiner(GATES)
    refiner.ones += sums[w : w + cells]
    refiner.all += sums[w + cells : w + 2 * cells]
    return Mixer(code, slot_bits, table, weights, refiner)
