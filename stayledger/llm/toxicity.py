"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

The kernel of two strings sums over common subsequences of three letters that span at most
``SPAN`` places, each weighed by a power of the places it takes in both, so that inserted or
left-out characters lower the likeness but do not end it. Its features can be listed, about
ten for each place, so kernel values come from table look-ups. Values are normalised and
raised to ``POWER``, which leaves a kernel a kernel and sets close likeness off from chance;
values below ``FLOOR`` count as none.

Texts are sentences; a sentence is compared with a landmark by its best matching unit,
where a unit is a word's letters, or a run of very short words together (letters spelled
apart). Landmarks are all units typical of toxic training documents by a test of
significance (the most typical ``TOXIC_LANDMARKS`` of them) and some of all others. The
Nyström map turns kernel values with the landmarks into features for a linear machine,
trained with the hinge loss on labelled sentences: sentences of clean documents are clean,
and of a toxic document the one sentence that looks worst is toxic (chosen anew each
round). A document is decided by a second linear machine on kernel values alone: the margin
of its worst sentence, for each toxic landmark the greatest and the summed kernel values of
the document's units, and how strong its strong units are together. Nothing counts by exact
match: a unit counts by its kernel values. Toxic training documents take part a second time
with a character inserted into each unit close to a landmark, at the weight ``tolerance``,
so that the machine learns to tolerate it. A logistic curve fitted on documents that the
machine has not seen gives the score.

Fitting uses at most ``sample_rows`` labelled rows of each label, by a hash of the id; the
landmarks' frequencies are counted on these. Scoring reads every row once, without a shuffle.

Defined results: a missing or empty text, or one without letters, has the score of a text
unlike all landmarks; labels that are missing or not 0 or 1 are left out. With labels of one
kind or none the score is that share, or 0. Columns go through, but for those named like a
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

SPAN = 6
DECAY = 0.6
POWER = 3
FLOOR = 0.1
SAMPLE_ROWS = 3000
TOXIC_LANDMARKS = 128
# Twice the log likelihood ratio of a unit's documents; about 1 in 16000 by chance.
SIGNIFICANT = 16.0
# Units this much like a toxic landmark are strong, and close.
STRONG, CLOSE = 0.5, 0.9
# Weight of a toxic training document with inserted characters.
INSERTED = 0.1
OTHER_LANDMARKS = 32
# So many sentences of a sampled document, the most landmark-like, bound the training sample.
SAMPLE_SENTENCES = 4
FOLDS = 4
DOCUMENT_RIDGE = 0.003
MIN_UNIT, LONGEST_UNIT = 3, 24
# A worker forgets words it has seen beyond so many.
REMEMBERED = 50_000
# It looks at so many bytes of text at once.
CHUNK_BYTES = 1 << 19

_NOT_LETTER = re.compile(r"[\W\d_]+")


def letters(word: str) -> str:
    word = word.lower()
    return word if word.isalpha() else _NOT_LETTER.sub("", word)


def windows(unit: str) -> list[str]:
    """A unit in overlapping windows of at most ``LONGEST_UNIT`` letters."""
    if len(unit) <= LONGEST_UNIT:
        return [unit]
    half = LONGEST_UNIT // 2
    return [unit[i : i + LONGEST_UNIT] for i in range(0, len(unit) - half, half)]


# Steps from the first letter of a subsequence to its second and third.
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, three letters as a number, weight) of all subsequences in reach.

    Letters fall into 64 classes: a to z alone, all others by their code point.
    """
    flat = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = np.where((flat >= 97) & (flat <= 122), flat - 96, 27 + flat % 37)
    sizes = np.array([len(x) for x in strings], np.int64)
    owner = np.repeat(np.arange(len(strings)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at, owners, codes, weights = np.arange(len(flat)), [], [], []
    for second, third in _STEPS:
        i = at[at + third < ends]
        owners.append(owner[i])
        codes.append(letter[i] << 12 | letter[i + second] << 6 | letter[i + third])
        weights.append(np.full(len(i), DECAY ** (third + 1)))
    return np.concatenate(owners), np.concatenate(codes), np.concatenate(weights)


def summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their weights."""
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(weight, first) if len(key) else weight


class Kernel:
    """Normalised kernel values with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        owner, code, weight = subsequences(landmarks)
        key, total = summed(owner << 18 | code, weight)
        owner, code = key >> 18, key & ((1 << 18) - 1)
        norm = np.sqrt(np.bincount(owner, total * total, len(landmarks)))
        order = np.lexsort((owner, code))
        owner, code, total = owner[order], code[order], total[order]
        # Landmarks of each subsequence, and their shares: entries first[code] to first[code + 1].
        self.first = np.searchsorted(code, np.arange((1 << 18) + 1))
        self.owner, self.share = owner, total / np.maximum(norm[owner], 1e-9)
        self.size = len(landmarks)

    def values(self, strings: list[str]) -> np.ndarray:
        owner, code, weight = subsequences(strings)
        met = np.zeros(len(strings), bool)
        met[owner[self.first[code + 1] > self.first[code]]] = True
        # All subsequences of strings that share one with a landmark: for their norms.
        near = met[owner]
        key, total = summed(owner[near] << 18 | code[near], weight[near])
        owner, code = key >> 18, key & ((1 << 18) - 1)
        norm = np.sqrt(np.bincount(owner, total * total, len(strings)))
        many = self.first[code + 1] - self.first[code]
        each = np.repeat(np.arange(len(code)), many)
        entry = np.arange(len(each)) - np.repeat(np.cumsum(many) - many - self.first[code], many)
        cell = owner[each] * self.size + self.owner[entry]
        out = np.bincount(cell, total[each] * self.share[entry], len(strings) * self.size)
        out = out.reshape(len(strings), self.size) / np.maximum(norm[:, None], 1e-9)
        out = np.minimum(out, 1) ** POWER
        return np.where(out < FLOOR, 0, out).astype(np.float32)


def inserted(unit: str) -> str:
    """A unit with a letter put in, both place and letter by its checksum."""
    mark = zlib.crc32(unit.encode())
    at = 1 + mark % max(1, len(unit) - 1)
    return unit[:at] + chr(97 + (mark >> 8) % 26) + unit[at:]


def pool_size(toxic: int) -> int:
    """Numbers that are pooled of a text, besides its size."""
    return 2 * toxic + 3


class Eye:
    """Kernel values of sentences with the landmarks, remembering words already seen.

    A sentence ends at a word that ends in a full stop, exclamation or question mark, and at
    the end of a line.
    """

    def __init__(self, landmarks: list[str] | None, toxic: int = 0):
        # The first ``toxic`` landmarks are those that documents are pooled for. Without landmarks it only counts units: every unit then has a row of its own.
        self.landmarks = landmarks
        self.toxic = toxic
        self.kernel = Kernel(landmarks) if landmarks is not None else None
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.short: list[str] = []
        self.runs: dict[str, int] = {}
        self.names: list[str] = [""]
        self.row = np.zeros(0, np.int32)
        self.is_short = np.zeros(0, bool)
        self.is_end = np.zeros(0, bool)
        self.rows = np.zeros((1, len(self.landmarks or [])), np.float32)

    def _rows_of(self, new: list[str]) -> np.ndarray:
        """Row numbers of new units; units unlike all landmarks share the empty row 0."""
        if self.kernel is None:
            self.names += new
            return np.arange(len(self.names) - len(new), len(self.names))
        if not new:
            return np.zeros(0, np.int32)
        values = self.values_of(new)
        some = values.any(1)
        rows = np.where(some, len(self.rows) - 1 + np.cumsum(some), 0)
        self.names += [u for u, s in zip(new, some.tolist()) if s]
        self.rows = np.concatenate([self.rows, values[some]])
        return rows

    def values_of(self, units: list[str]) -> np.ndarray:
        """Kernel values of units; a long one has the best of its windows."""
        split = [windows(u) for u in units]
        sizes = np.array([len(x) for x in split])
        parts = [w for x in split for w in x]
        values = np.concatenate([self.kernel.values(parts[a : a + 256]) for a in range(0, len(parts), 256)])
        if len(parts) > len(units):
            values = np.maximum.reduceat(values, np.cumsum(sizes) - sizes, axis=0)
        return values

    def _learn_words(self, new: list[str]) -> None:
        bare = [letters(w) for w in new]
        short = np.array([len(u) < MIN_UNIT for u in bare], bool)
        rows = np.zeros(len(new), np.int32)
        rows[~short] = self._rows_of([u for u in bare if len(u) >= MIN_UNIT])
        first = len(self.row)
        self.words.update(zip(new, range(first, first + len(new))))
        self.short += [u if len(u) < MIN_UNIT else "" for u in bare]
        self.row = np.concatenate([self.row, rows])
        self.is_short = np.concatenate([self.is_short, short])
        self.is_end = np.concatenate([self.is_end, np.array([w[-1] in ".!?" for w in new], bool)])

    def met(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows other than 0 that occur, the sentence of each in order, and sentences' texts."""
        if len(self.words) + len(self.runs) > REMEMBERED:
            self._forget()
        words: list[str] = []
        breaks, owner = [], []
        for i, text in enumerate(texts):
            for line in text.split("\n"):
                found = line.split()
                if found:
                    words += found
                    breaks.append(len(words) - 1)
                    owner += [i] * len(found)
        n = len(words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh = [w for w in dict.fromkeys(words) if w not in self.words]
        if fresh:
            self._learn_words(fresh)
        ids = np.fromiter(map(self.words.__getitem__, words), np.int64, n)
        end = self.is_end[ids]
        end[breaks] = True
        sentence = np.cumsum(end) - end
        text_of = np.zeros(sentence[-1] + 1, np.int64)
        text_of[sentence] = owner
        # Runs of at least two short words within a sentence.
        short = self.is_short[ids]
        key = np.where(short, sentence, -1)
        start = np.r_[True, key[1:] != key[:-1]] & short
        last = np.r_[key[1:] != key[:-1], True] & short
        a, z = np.flatnonzero(start), np.flatnonzero(last)
        far = z > a
        where, joined = [], []
        for i, j in zip(a[far].tolist(), z[far].tolist()):
            run = "".join([self.short[k] for k in ids[i : j + 1].tolist()])
            if len(run) >= MIN_UNIT:
                where.append(sentence[i])
                joined.append(run)
        new = [r for r in dict.fromkeys(joined) if r not in self.runs]
        self.runs.update(zip(new, self._rows_of(new).tolist()))
        rows = self.row[ids]
        some = rows > 0
        row = np.concatenate([rows[some], np.array([self.runs[r] for r in joined], np.int64)])
        at = np.concatenate([sentence[some], np.array(where, np.int64)])
        keep = row > 0
        row, at = row[keep], at[keep]
        order = np.argsort(at, kind="stable")
        return row[order], at[order], text_of

    def changed(self, row: np.ndarray) -> np.ndarray:
        """Row numbers with units close to a toxic landmark replaced by ones with a character inserted."""
        rows, back = np.unique(row, return_inverse=True)
        close = np.flatnonzero(self.rows[rows, : self.toxic].max(1, initial=0) >= CLOSE)
        if len(close):
            rows[close] = self._rows_of([inserted(self.names[r]) for r in rows[close].tolist()])
        return rows[back]

    def pooled(self, row: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Of each text what its distinct units give together, a unit being a row other than 0."""
        out = np.zeros((n, pool_size(self.toxic)), np.float32)
        pairs = np.unique(text << 32 | row)
        if not len(pairs) or not self.toxic:
            return out
        at, rows = pairs >> 32, pairs & 0xFFFFFFFF
        values = self.rows[rows, : self.toxic]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        some, best = at[first], values.max(1)
        out[some, : self.toxic] = np.maximum.reduceat(values, first, axis=0)
        out[some, self.toxic : 2 * self.toxic] = np.add.reduceat(values, first, axis=0)
        out[some, -3] = np.add.reduceat(np.where(best >= STRONG, best, 0), first)
        out[some, -2] = np.add.reduceat((best >= CLOSE).astype(np.float32), first)
        out[:, self.toxic :] = np.log1p(out[:, self.toxic :])
        out[some, -1] = np.maximum.reduceat(best, first)
        return out

    def look(self, texts: list[str], insert: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best kernel values of the sentences that have some, the text each is from, and pools of all texts.

        ``insert`` looks at the texts with a character inserted into units close to a landmark.
        """
        row, at, text_of = self.met(texts)
        if insert and len(row):
            row = self.changed(row)
            row, at = row[row > 0], at[row > 0]
        pools = self.pooled(row, text_of[at] if len(row) else row, len(texts))
        # Longer texts hold more units like a landmark by chance.
        pools = np.column_stack([pools, np.log1p([t.count(" ") for t in texts])]).astype(np.float32)
        if not len(row):
            return np.zeros((0, self.rows.shape[1]), np.float32), np.zeros(0, np.int64), pools
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        many = np.diff(np.r_[first, len(row)])
        best = self.rows[row[first]]
        # The second rows of all sentences that have one, then the third, and so on.
        for k in range(1, int(many.max())):
            live = np.flatnonzero(many > k)
            if len(live) < 16:
                for i in live.tolist():
                    best[i] = self.rows[row[first[i] : first[i] + many[i]]].max(0)
                break
            best[live] = np.maximum(best[live], self.rows[row[first[live] + k]])
        return best, text_of[at[first]], pools


@dataclass
class Machine:
    landmarks: list[str]
    toxic: int
    project: np.ndarray
    weight: np.ndarray
    bias: float
    # Weights of a document's worst margin and pools.
    whole: np.ndarray
    whole_bias: float
    slope: float
    shift: float

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Of sentences."""
        return values @ (self.project @ self.weight) + self.bias

    def document_margins(self, worst: np.ndarray, pools: np.ndarray) -> np.ndarray:
        return np.column_stack([worst, pools]) @ self.whole + self.whole_bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def choose_landmarks(docs: DataFrame, counts: dict[int, int]) -> tuple[list[str], int]:
    """Landmarks, the toxic ones first, and the number of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, "text", CHUNK_BYTES):
                eye = Eye(None)
                row, at, text_of = eye.met(common.texts(batch))
                pairs = np.unique(text_of[at] << 32 | row)
                found = [eye.names[r] for r in (pairs & 0xFFFFFFFF).tolist()]
                ys = batch.column("y").take(pa.array(pairs >> 32))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), ys], ["unit", "y"])

    seen = docs.select("y", "text").mapInArrow(run, "unit string, y int")
    by_unit = seen.groupBy("unit").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("good"),
    )
    bad, good = F.col("bad") / counts[1], F.col("good") / counts[0]
    # Standardised difference of the two shares.
    spread = F.sqrt(bad * (1 - bad) / counts[1] + good * (1 - good) / counts[0] + F.lit(1e-6))
    # How much likelier its documents' labels are with a share of the unit's own.
    share = counts[1] / (counts[0] + counts[1])
    of = lambda n, p: F.when(n > 0, n * F.log(n / (F.col("bad") + F.col("good")) / p)).otherwise(0.0)
    ratio = 2 * (of(F.col("bad"), share) + of(F.col("good"), 1 - share))
    ranked = by_unit.where(F.length("unit") <= LONGEST_UNIT).select("unit", ((bad - good) / spread).alias("z"), ratio.alias("ratio"), (F.col("bad") + F.col("good")).alias("n"))
    typical = ranked.where(F.expr("n >= 4 and z > 0") & (F.col("ratio") >= SIGNIFICANT))
    chosen = [r["unit"] for r in typical.orderBy(F.desc("ratio"), "unit").limit(TOXIC_LANDMARKS).collect()]
    others = ranked.where("n >= 5 and z <= 0 and length(unit) between 4 and 10").orderBy(F.xxhash64(F.lit(3), "unit"), "unit").limit(OTHER_LANDMARKS).collect()
    return chosen + [r["unit"] for r in others], len(chosen)


def nystroem(eye: Eye) -> np.ndarray:
    gram = eye.kernel.values(eye.landmarks).astype(float)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-3
    return vectors[:, keep] / np.sqrt(values[keep])


def hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with the weighted squared hinge loss, by Newton steps on the rows inside the margin."""
    one = np.column_stack([x, np.ones(len(x))])
    damp = np.r_[np.full(x.shape[1], ridge), 1e-9]
    loss = lambda w: float((cost * np.maximum(0, 1 - y * (one @ w)) ** 2).sum() + 0.5 * (damp * w * w).sum())
    w = np.zeros(one.shape[1])
    now = loss(w)
    for _ in range(rounds):
        gap = 1 - y * (one @ w)
        inside = gap > 0
        rows, weight = one[inside], 2 * cost[inside]
        slope = damp * w - rows.T @ (weight * y[inside] * gap[inside])
        step = np.linalg.solve((rows * weight[:, None]).T @ rows + np.diag(damp) + 1e-12 * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        before, now = now, min(now, loss(w - size * step))
        if size <= 1e-6 or before - now <= 1e-9 * before:
            break
        w = w - size * step
    return w[:-1], float(w[-1])


def curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps."""
    x = np.stack([margin, np.ones_like(margin)], 1)
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-4 * a
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        a = a + step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
    return float(a[0]), float(a[1])


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, tolerance: float = INSERTED
) -> Machine | float:
    """A machine from labelled documents; the share of toxic ones where there are no two kinds.

    ``tolerance`` is the weight of toxic documents with inserted characters: more of it finds
    more insults with changed letters, and takes more chance likenesses for such.
    """
    sample, counts = common.labelled_sample(labels, label, sample_rows, seed=7)
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.0
    # At most twice sample_rows ids go to all executors, so no text is shuffled.
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    used = {y: min(n, sample_rows) for y, n in counts.items()}
    landmarks, toxic = choose_landmarks(known, used)
    if not toxic:
        return counts[1] / total
    width = pool_size(toxic) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        eye = Eye(landmarks, toxic)
        for whole in batches:
            for batch in common.chunks(whole, "text", CHUNK_BYTES):
                texts = common.texts(batch)
                columns = [batch.column("doc_id"), batch.column("y")]
                for insert in (False, True):
                    values, owner, pools = eye.look(texts, insert)
                    order = np.lexsort((-values[:, :toxic].max(1), owner)) if len(values) else np.zeros(0, np.int64)
                    ends = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                    held = [values[order[a : min(z, a + SAMPLE_SENTENCES)]].tobytes() for a, z in zip(ends, ends[1:])]
                    columns += [pa.array(held, pa.binary()), pa.array([p.tobytes() for p in pools], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "y", "v", "pool", "v_changed", "pool_changed"])

    # At most a few kilobytes for each of the sampled rows, as one block.
    found = known.select(F.xxhash64("doc_id").alias("doc_id"), "y", "text").mapInArrow(run, "doc_id long, y int, v binary, pool binary, v_changed binary, pool_changed binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("v", "ascending"), ("pool", "ascending")])
    label_of = found.column("y").to_numpy()
    if len(set(label_of.tolist())) < 2:
        return counts[1] / total
    ids = found.column("doc_id").to_numpy()
    name = np.cumsum(np.r_[False, ids[1:] != ids[:-1]])
    pools, changed_pools = (
        np.frombuffer(b"".join(found.column(c).to_pylist()), np.float32).reshape(len(name), width).astype(float) for c in ("pool", "pool_changed")
    )
    x, row = sentences_of(found.column("v"), len(landmarks))
    y, doc = label_of[row], name[row]
    project = nystroem(Eye(landmarks))
    z, start = x @ project, x[:, :toxic].max(1) if len(x) else np.zeros(0)
    del x
    # A document's inputs have the margin that machines give which have not seen it.
    held = np.full(len(y), np.nan)
    for fold in range(FOLDS):
        out = doc % FOLDS == fold
        if len(set(y[~out].tolist())) == 2 and out.any():
            w, b = machine(z[~out], y[~out], doc[~out], start[~out])
            held[out] = z[out] @ w + b
    if len(set(y.tolist())) < 2:
        return counts[1] / total
    w, b = machine(z, y, doc, start)
    held = np.where(np.isnan(held), z @ w + b, held)
    bad = label_of == 1
    worst = greatest(held, row, len(name), b)
    x, row = sentences_of(found.column("v_changed"), len(landmarks))
    changed = greatest(x @ project @ w + b, row, len(name), b)
    inputs = np.concatenate([np.column_stack([worst, pools]), np.column_stack([changed, changed_pools])[bad]])
    label_of, fold_of = np.r_[label_of, label_of[bad]], np.r_[name, name[bad]] % FOLDS
    share = np.r_[np.ones(len(name)), np.full(bad.sum(), tolerance)]
    whole, whole_bias = document_machine(inputs, label_of, share, bad.sum())
    held = inputs @ whole + whole_bias
    for fold in range(FOLDS):
        out = fold_of == fold
        if len(set(label_of[~out].tolist())) == 2 and out.any():
            v, c = document_machine(inputs[~out], label_of[~out], share[~out], bad.sum())
            held[out] = inputs[out] @ v + c
    # Rows count so that labels have their natural shares again.
    each = [counts[k] / total / max(1e-9, share[label_of == k].sum()) for k in (0, 1)]
    slope, shift = curve(held, label_of.astype(float), share * np.where(label_of == 1, each[1], each[0]) * len(name))
    return Machine(landmarks, toxic, project, w, b, whole, whole_bias, slope, shift)


def sentences_of(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Kernel values of all sentences held by some documents, and the document of each."""
    held = [np.frombuffer(v, np.float32).reshape(-1, width) for v in column.to_pylist()]
    return np.concatenate(held).astype(float), np.repeat(np.arange(len(held)), [len(v) for v in held])


def greatest(margin: np.ndarray, doc: np.ndarray, n: int, bias: float) -> np.ndarray:
    """The greatest margin of each document; a sentence unlike all landmarks has the bias as its margin."""
    out = np.full(n, float(bias))
    np.maximum.at(out, doc, margin)
    return out


def document_machine(inputs: np.ndarray, y: np.ndarray, share: np.ndarray, plain: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear machine over documents; the ``plain`` toxic ones weigh as much as the clean."""
    cost = share * np.where(y == 1, 1.0 / max(1, plain), 1.0 / max(1, (y == 0).sum()))
    return hinge(inputs, np.where(y == 1, 1.0, -1.0), cost, ridge=DOCUMENT_RIDGE)


def worst_of(margin: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for the one sentence of each document with the greatest margin."""
    order = np.lexsort((-margin, doc))
    out = np.zeros(len(doc), bool)
    out[order[np.r_[True, np.diff(doc[order]) != 0]]] = True
    return out


def machine(z: np.ndarray, y: np.ndarray, doc: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias; of a toxic document the sentence that looks worst counts, of a clean one all."""
    for _ in range(4):
        worst = worst_of(margin, doc)
        use = (y == 0) | worst
        cost = np.where(y == 1, 1.0 / max(1, (use & (y == 1)).sum()), 1.0 / max(1, (y == 0).sum()))
        w, b = hinge(z[use], np.where(y[use] == 1, 1.0, -1.0), cost[use])
        margin = z @ w + b
    return w, b


def score(docs: DataFrame, model: Machine | float, text: str = "text") -> DataFrame:
    """Documents with ``margin``, ``score`` and ``predicted``."""
    keep = common.carried(docs, ["margin", "score", "predicted"])
    docs = docs.select(*[f"`{c}`" for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        eye = None if isinstance(model, float) else Eye(model.landmarks, model.toxic)
        for whole in batches:
            for batch in common.chunks(whole, text, CHUNK_BYTES):
                n = batch.num_rows
                if eye is None:
                    margin, s = np.zeros(n), np.full(n, model)
                else:
                    values, owner, pools = eye.look(common.texts(batch, text))
                    margin = model.document_margins(greatest(model.margins(values), owner, n, model.bias), pools)
                    s = model.scores(margin)
                new = [pa.array(margin), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
                yield common.append(batch, new, ["margin", "score", "predicted"])

    return docs.mapInArrow(run, common.added(docs, "margin double, score double, predicted int"))
