"""Language-model scores by logistic context mixing over bits.

A text is a row of tokens: its words, lower-cased (A-Z), and one end. Tokens met often in
training have a code, and the row of codes is predicted bit by bit from several hashed
contexts, the tokens before among them (see ``mixing``). A token without a code is an
escape in this row, followed by the token itself:

    P(token | escape) = c / (R + W + 1), or if it is not known (W + 1) / (R + W + 1) * P(bytes)

with c the token's count in training, R tokens and W distinct ones without a code there. An
unknown token is spelled as its bytes and a blank (the end: a line feed), by context
mixing too: predictors hash the last 0 to 4 bytes of the word, or all of it, with the bits
of the byte so far into tables of counts, and are combined by weights that depend on the
place in the word and the bit. Last, a document adapts to its own tokens without a code:
the t-th has the probability (a * P + how often it has come before) / (a + t - 1), for
several strengths ``a`` and without adapting, and their probability is the mean of these.

Every score begins with the kind of the document, one of 32 with equal shares. The product
over adaptive steps does not depend on their order, so these tokens need their counts only.

All counts are taken over all training texts. Counts of tokens grow with the corpus; the
tables of contexts grow up to a bound (``mixing.MOST_SLOT_BITS``). The spelling counts each
distinct token once, as unknown tokens are new ones. Weights and maps are learnt online,
each token left out of the counts while predicted, on all training texts and all distinct
tokens, and averaged over the parts.

Defined results: a missing or empty text is its end alone; equal rows get equal results;
without training texts all counts are 0. Only the id and the text of the documents are used.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common, mixing
from stayledger.llm.mixing import KINDS, MAP_CELLS, Refiner, squash
from stayledger.storage import stage_table

STRENGTHS = (100.0, 1000.0, 10000.0)
WAYS = 1 + len(STRENGTHS)
# The last 0 to 4 bytes of the word, and the whole word so far.
PREDICTORS = 6
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
PLACES = 8
GATES = PLACES * 8
PRIOR = 0.4
STEP = 0.05
BATCH_WORDS = 4096
LONG_WORD = 256
# Words with a code, which every task holds: at most so many, of at most so many bytes each.
FREQUENT, FREQUENT_BYTES = 1 << 18, 64
# A task passes its counts on beyond so many distinct words.
HELD_WORDS = 400_000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)
_C = np.uint64(0xBF58476D1CE4E5B9)


def tokens(text: bytes) -> list[bytes]:
    """Words, lower-cased; bytes splits at exactly the six ASCII blanks."""
    return text.lower().split()


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for arguments of at least 1."""
    product = np.ones_like(z)
    for i in range(7):
        product = product * (z + i)
    y = z + 7
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - np.log(product)


def log10_rising(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 of x (x + 1) ... (x + n - 1), for positive x and n."""
    return (np.log(x) + log_gamma(x + n) - log_gamma(x + 1.0)) / math.log(10)


def ways(log_p: np.ndarray, times: np.ndarray) -> np.ndarray:
    """log10 of what a token adds that occurs so often, one row without and one per strength."""
    p = 10 ** np.maximum(log_p, -290)
    return np.stack([log_p * times, *(log10_rising(a * p, times) for a in STRENGTHS)])


def spelled(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Batches of tokens by falling length: their numbers, and bytes with the closing one."""
    full = [w + b" " if w else b"\n" for w in words]
    order = sorted(range(len(full)), key=lambda i: -len(full[i]))
    at = 0
    while at < len(order):
        size = 16 if len(full[order[at]]) > LONG_WORD else BATCH_WORDS
        part = order[at : at + size]
        yield np.array(part), [full[i] for i in part]
        at += size


def bit_steps(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each bit in turn: how many words still have it, slots by predictor, bits, nodes, gate."""
    lengths = np.array([len(w) for w in words])
    table = np.zeros((lengths[0], len(words)), np.uint8)
    flat = np.frombuffer(b"".join(words), np.uint8)
    at = np.repeat(np.arange(len(words)), lengths)
    table[np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths), at] = flat
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    whole = np.full(len(words), 7, np.uint64)
    zero = np.zeros(len(words), np.uint64)
    for t in range(lengths[0]):
        k = int(alive[t])
        contexts = [zero[:k]]
        for back in range(1, PREDICTORS - 1):
            last = table[t - back, :k].astype(np.uint64) + np.uint64(1) if t >= back else zero[:k]
            contexts.append(contexts[-1] * np.uint64(257) + last)
        contexts.append(whole[:k])
        hashed = np.stack([(c + np.uint64(i + 1)) * _A ^ (c >> np.uint64(29)) for i, c in enumerate(contexts)])
        byte = table[t, :k]
        node = np.ones(k, np.uint64)
        for b in range(8):
            bit = (byte >> (7 - b)) & 1
            slots = ((hashed + node * _B) * _C) >> np.uint64(64 - SLOT_BITS)
            yield k, slots.astype(np.int64), bit, node.astype(np.int64), min(t, PLACES - 1) * 8 + b
            node = node * np.uint64(2) + bit
        whole[:k] = (whole[:k] + byte + np.uint64(1)) * _B


def taken(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Each predictor's values at its slots."""
    return np.stack([np.take(row, at) for row, at in zip(table, slots)])


@dataclass
class Speller:
    """Trained predictors, weights and map: log10 probability of spelled tokens."""

    inputs: np.ndarray
    weights: np.ndarray
    refiner: Refiner

    def log10(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words))
        for numbers, batch in spelled(words):
            total = np.zeros(len(batch))
            for k, slots, bit, node, gate in bit_steps(batch):
                x = self.weights[gate] @ taken(self.inputs, slots)
                p = self.refiner.refine(x, node)
                total[:k] += np.log10(np.where(bit == 1, p, 1 - p))
            out[numbers] = total
        return out


def count_tokens(docs: DataFrame) -> DataFrame:
    """Tokens of all texts: ``word`` (bytes, none for the end) and ``c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"]
            )
            held.clear()
            return batch

        for whole in batches:
            for batch in common.chunks(whole, "text"):
                for text in common.byte_texts(batch):
                    held.update(tokens(text))
                    held[b""] += 1
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def context_counts(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones seen in each slot of each predictor, over distinct tokens; of a fixed size."""
    size = PREDICTORS * SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Zeros and ones of a slot side by side.
        seen = np.zeros(2 * size, np.int32)
        offset = np.arange(PREDICTORS)[:, None] * SLOTS
        for batch in batches:
            for _, part in spelled(batch.column("word").to_pylist()):
                for _, slots, bit, _, _ in bit_steps(part):
                    for at in ((slots + offset) << 1) + bit:
                        np.add.at(seen, at, np.int32(1))
        seen = seen.reshape(-1, 2)
        some = np.flatnonzero(seen[:, 0] | seen[:, 1])
        for a in range(0, len(some), 1 << 16):
            i = some[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), *(pa.array(seen[i, bit].astype(np.int64)) for bit in (0, 1))],
                ["slot", "zeros", "ones"],
            )

    found = words.select("word").mapInArrow(run, "slot int, zeros long, ones long")
    # At most PREDICTORS * SLOTS rows, whatever the corpus.
    sums = found.groupBy("slot").agg(F.sum("zeros").cast("float"), F.sum("ones").cast("float")).toArrow()
    zeros, ones = np.zeros(size, np.float32), np.zeros(size, np.float32)
    slot = sums.column(0).to_numpy()
    zeros[slot], ones[slot] = sums.column(1).to_numpy(), sums.column(2).to_numpy()
    return zeros.reshape(PREDICTORS, SLOTS), ones.reshape(PREDICTORS, SLOTS)


def learn_online(batches: Iterator[list[bytes]], zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, Refiner, int]:
    """One online pass over tokens that are in the counts; each is left out while predicted."""
    weights = np.full((GATES, PREDICTORS), 0.3)
    slopes = np.full((GATES, PREDICTORS), 1e-4)
    refiner, n = Refiner(256), 0
    # What a bit's own count and the prior add to zeros and ones.
    less = np.array([[PRIOR - 1, PRIOR], [PRIOR, PRIOR - 1]], np.float32)
    # Both counts of a slot side by side, looked up at once.
    both = np.stack([zeros, ones], -1).astype(np.float32).view(np.int64)[..., 0]
    for words in batches:
        for _, part in spelled(words):
            n += len(part)
            for k, slots, bit, node, gate in bit_steps(part):
                counts = np.log(taken(both, slots).view(np.float32).reshape(*slots.shape, 2) + less[bit])
                inputs = counts[..., 1] - counts[..., 0]
                x = weights[gate] @ inputs
                slope = inputs @ (bit - squash(x)) / k
                slopes[gate] += slope * slope
                weights[gate] += STEP * slope / np.sqrt(slopes[gate])
                refiner.learn(x, node, bit)
    return weights, refiner, n


def train_speller(words: DataFrame) -> Speller:
    """Context counts, then weights and map averaged over the parts they were learnt on."""
    zeros, ones = context_counts(words)
    shared = words.sparkSession.sparkContext.broadcast((zeros, ones))
    cells = 256 * MAP_CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, refiner, n = learn_online(
            (b.column("word").to_pylist() for b in batches), *shared.value
        )
        start = Refiner(256)
        values = np.r_[weights.ravel() * n, refiner.ones - start.ones, refiner.all - start.all, n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "value"]
        )

    # The same number of values from each part; as many rows in the end.
    learnt = words.select("word").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.zeros(GATES * PREDICTORS + 2 * cells + 1)
    for r in learnt.collect():
        total[r["at"]] = r["value"]
    shared.unpersist()
    w = GATES * PREDICTORS
    weights = total[:w] / total[-1] if total[-1] else np.full(w, 0.3)
    refiner = Refiner(256)
    refiner.ones += total[w : w + cells]
    refiner.all += total[w + cells : w + 2 * cells]
    inputs = (np.log(ones + np.float32(PRIOR)) - np.log(zeros + np.float32(PRIOR))).astype(np.float32)
    return Speller(inputs, weights.reshape(GATES, PREDICTORS), refiner)


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and scores of every row; ``training`` says, by id, which rows are learnt from.

    Tokens with a code are scored where the text is read; other words of a document meet
    their counts in a join on the word, and the document's sums meet in a grouping.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), training.alias("trains"))
    taught = rows.where("trains")
    words = stage_table(count_tokens(taught), "token-counts")
    size = F.floor(F.log2("c")).cast("int")
    brief = F.length("word") <= FREQUENT_BYTES
    by_size = words.groupBy(size.alias("size")).agg(
        F.count(F.lit(1)).alias("v"), F.sum("c").alias("n"), F.sum(brief.cast("long")).alias("short")
    ).collect()
    n, v = sum(r["n"] for r in by_size), sum(r["v"] for r in by_size)
    # The smallest power of two that at most FREQUENT short words reach, 2 at least: words met
    # once are as many as there are new ones to be expected, and stand for these.
    least, held = 64, 0
    for r in sorted(by_size, key=lambda r: -r["size"]):
        held += r["short"]
        if held > FREQUENT or r["size"] < 1:
            break
        least = r["size"]
    # At most FREQUENT rows, in an order of their own.
    often = words.where((size >= least) & brief).select("word", "c").toArrow().sort_by("word")
    names, counts = often.column(0).to_pylist(), often.column(1).to_pylist()
    often_c = np.array(counts, float)
    n_other, v_other = n - sum(counts), v - len(counts)
    speller = common.sent_to_workers(docs.sparkSession, train_speller(words))
    model = mixing.train(taught, mixing.Code(names, counts, n_other + v_other + 1), n, taught)
    mixer = common.sent_to_workers(docs.sparkSession, model)
    log_all, log_other = math.log10(n + v + 1), math.log10(n_other + v_other + 1)
    log_new = math.log10(v_other + 1) - log_other

    def log_base(c: np.ndarray) -> np.ndarray:
        return np.log10(c + 1.0) - log_all

    way_names = [f"way_{i}" for i in range(WAYS)]
    sums = ["mixed", "base", *way_names]
    keys = ["doc_id", "body_hash"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row its sums over tokens with a code, and a row for each other word."""
        base = log_base(often_c)
        for whole in batches:
            for batch in common.chunks(whole, "text", mixing.PIECE_BYTES):
                n_rows = batch.num_rows
                found = mixer().code.read(common.byte_texts(batch))
                coded = found.ids < len(base)
                n_known = np.bincount(found.row[coded], minlength=n_rows)
                others = [(i, w, c) for i, each in enumerate(found.others) for w, c in each.items()]
                other_row = np.array([i for i, _, _ in others], np.int64)
                more, many = np.zeros(len(others)), np.zeros(len(others), np.int64)
                left = found.total - n_known
                # The steps' denominators, once a row; adapting to nothing changes nothing.
                ways_ = [np.zeros(n_rows), *(np.where(left > 0, -log10_rising(np.full(n_rows, a), left), 0) for a in STRENGTHS)]
                columns = [
                    # A key that no word equals, so that sums take the same way.
                    pa.array([b"\n%d" % i for i in range(n_rows)] + [w for _, w, _ in others], pa.binary()),
                    pa.array(np.r_[found.total, np.array([c for _, _, c in others], np.int64)]),
                    pa.array(np.r_[n_known, many]),
                    pa.array(np.r_[found.sizes, many]),
                    pa.array(np.r_[mixer().log10(found), more]),
                    pa.array(np.r_[np.bincount(found.row[coded], base[found.ids[coded]], n_rows), more]),
                    *(pa.array(np.r_[x, more]) for x in ways_),
                ]
                source = pa.array(np.r_[np.arange(n_rows), other_row])
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(keys).take(source).columns, *columns],
                    [*keys, "word", "times", "n_known", "n_bytes", *sums],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    sum_types = ", ".join(f"{w} double" for w in sums)
    scanned = rows.select("doc_id", F.xxhash64("text").alias("body_hash"), "text").mapInArrow(
        scan, f"doc_id {id_type}, body_hash long, word binary, times long, n_known long, n_bytes long, {sum_types}"
    )

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Score the other words, spelling the unknown ones; rows that are sums go through."""
        for batch in batches:
            c = batch.column("c").to_numpy().astype(float)
            is_sum = c < 0
            new = np.flatnonzero(c == 0)
            found = batch.column("word").take(pa.array(new)).to_pylist()
            place = {w: i for i, w in enumerate(dict.fromkeys(found))}
            log_p = np.log10(np.maximum(c, 1.0)) - log_other
            if place:
                log_p[new] = log_new + speller().log10(list(place))[[place[w] for w in found]]
            times = batch.column("times").to_numpy()
            added = ways(np.where(is_sum, 0.0, log_p), times)
            given = {name: batch.column(name).to_numpy() for name in ("n_known", "n_bytes", *sums)}
            out = {
                "copies": is_sum.astype(np.int64),
                "n_tokens": np.where(is_sum, times, 0),
                "n_known": np.where(is_sum, given["n_known"], np.where(c > 0, times, 0)),
                "n_bytes": given["n_bytes"],
                "mixed": given["mixed"],
                "base": np.where(is_sum, given["base"], times * log_base(np.maximum(c, 0))),
            }
            for name, x in zip(way_names, added):
                out[name] = np.where(is_sum, given[name], x)
            yield common.append(batch.select(keys), [pa.array(x) for x in out.values()], list(out))

    # Words without a code alone are looked up; sums are told by a count below 0.
    rare = words.where((size < least) | ~brief).select("word", F.col("c").alias("c_all"))
    is_sum = F.startswith("word", F.lit(b"\n"))
    joined = scanned.join(rare, "word", "left").select(
        *keys, F.when(is_sum, F.lit(b"")).otherwise(F.col("word")).alias("word"), "times", "n_known", "n_bytes", *sums,
        F.when(is_sum, F.lit(-1)).otherwise(F.coalesce("c_all", F.lit(0))).cast("long").alias("c"),
    )
    parts = joined.mapInArrow(
        rest, f"doc_id {id_type}, body_hash long, copies long, n_tokens long, n_known long, n_bytes long, {sum_types}"
    )
    total = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns[2:]])
    # Equal rows were summed up together: each gets its share.
    share = [(F.col(c) / F.col("copies")).alias(c) for c in sums]
    counts_ = [(F.col(c) / F.col("copies")).cast("long").alias(c) for c in ("n_tokens", "n_known", "n_bytes")]
    each = total.select(
        "doc_id", *counts_, *share, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    best = F.greatest(*way_names)
    mean = best + F.log10(sum(F.pow(F.lit(10.0), F.col(w) - best) for w in way_names) / WAYS)
    out = each.select(
        "doc_id", "n_tokens", "n_known", "n_bytes", F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("mixed") + mean - math.log10(KINDS)).alias("score"),
    )
    return out.withColumn("bits_per_byte", -F.col("score") * math.log2(10) / (F.col("n_bytes") + 1))
