"""Quality classifier by Bradley-Terry ranking.

A document's worth is linear in features of its whole text. From labelled documents come
preference pairs, a good one before a bad one; the chance that a pair is ordered rightly
is the logistic function of the difference of worths, so the loss is logistic on feature
differences. A quantile of the training documents' worths, at the share of bad ones, is the
threshold, and the score is the logistic function of what a document has above it.

Fitting uses a bounded sample of labelled rows (``sample_rows`` of each label, by a hash of
the id) and happens on the driver; scoring reads every row once, without a shuffle.

Defined results: a missing or empty text has all features zero and the score that goes
with them; labels that are missing or not 0 or 1 are left out; of repeated labels each
counts. With labels of one kind or none the score is that share, or one half. Columns go
through, but for those named like a result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

SAMPLE_ROWS = 4000
PAIRS_PER_ROW = 8
ROUNDS = 25
RIDGE = 1e-3

# Byte classes: each byte counts for one.
_CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "exclaim", "bar", "symbol", "other", "high")


def _class(c: int) -> int:
    ch = chr(c)
    if c >= 128:
        return 10
    for k, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".,;:?'\"()-", "!", "|", "#*$%&<>_=+@^~\\/{}[]`")):
        if ch in members:
            return k
    return 9


_TABLE = np.array([_class(c) for c in range(256)], np.uint8)
FEATURES = (
    *_CLASSES, "log_bytes", "word_bytes", "distinct_words", "repeated_threes", "top_word",
    "repeated_lines", "closed_lines", "capital_words", "marked_words", "short_words",
)


def features(text: bytes) -> list[float]:
    """Shares between 0 and 1, and two logarithms of sizes, of one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    classes = np.bincount(_TABLE[np.frombuffer(text, np.uint8)], minlength=len(_CLASSES)) / n
    words = text.split()
    m = len(words)
    if not m:
        return [*classes, np.log1p(n) / 10, *[0.0] * 9]
    counts = Counter(words)
    threes = len(words) - 2
    again = 1 - len(set(zip(words, words[1:], words[2:]))) / threes if threes > 0 else 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    closed = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines)
    capital = marked = short = 0
    for word, c in counts.items():
        capital += c * (len(word) > 1 and word.isupper())
        marked += c * (word[-1:] in (b"*", b"#", b"$", b"%", b"&", b"!", b"|"))
        short += c * (len(word) <= 3)
    return [
        *classes,
        np.log1p(n) / 10,
        min(1.0, n / m / 20),
        len(counts) / m,
        again,
        max(counts.values()) / m,
        1 - len(set(lines)) / len(lines),
        closed,
        capital / m,
        marked / m,
        short / m,
    ]


def featured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with ``features`` instead of their text."""
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in common.byte_texts(batch, text)]
            yield common.append(
                batch.select(keep), [pa.array(rows, pa.list_(pa.float64()))], ["features"]
            )

    return docs.mapInArrow(run, common.added(docs.drop(text), "features array<double>"))


@dataclass
class Ranker:
    """Standardised weights and the threshold on their sum."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float
    sharpness: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sharpness * (self.worth(x) - self.threshold), -30, 30)))


def fit(x: np.ndarray, label: np.ndarray, share_bad: float, seed: int = 5) -> Ranker:
    """Weights from preference pairs by Newton steps; both labels must occur in ``x``."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -6, 6)
    pairs = max(len(good), len(bad)) * PAIRS_PER_ROW
    # Every row is in about as many pairs as others of its label.
    first = np.concatenate([rng.permutation(good) for _ in range(-(-pairs // len(good)))])[:pairs]
    second = np.concatenate([rng.permutation(bad) for _ in range(-(-pairs // len(bad)))])[:pairs]
    d = z[first] - z[second]
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        slope = d.T @ p / pairs - RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    # The quantile is taken over labels in their natural shares.
    worth = z @ w
    order = np.argsort(worth)
    weight = np.where(label == 1, (1 - share_bad) / len(good), share_bad / len(bad))[order]
    at = int(np.searchsorted(np.cumsum(weight), share_bad))
    at = min(max(at, 1), len(order) - 1)
    threshold = float((worth[order[at - 1]] + worth[order[at]]) / 2)
    return Ranker(mean, scale, w, threshold, 1.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Ranker | float:
    """A ranker from labelled documents; the share of good ones where there are no pairs."""
    sample, counts = common.labelled_sample(labels, label, sample_rows, seed=11)
    total = sum(counts.values())
    if len(counts) < 2:
        return counts.get(1, 0) / total if total else 0.5
    # At most twice sample_rows ids go to all executors, so no text is shuffled.
    rows = featured(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], r["features"]))
    x, y = np.array([r["features"] for r in rows]), np.array([r["y"] for r in rows])
    if len(set(y.tolist())) < 2:
        return counts.get(1, 0) / total
    return fit(x, y, counts[0] / total)


def score(docs: DataFrame, model: Ranker | float, text: str = "text") -> DataFrame:
    """Documents with ``worth``, ``score`` and ``predicted``."""
    keep = common.carried(docs, ["worth", "score", "predicted"])
    docs = docs.select(*[f"`{c}`" for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, text):
                x = np.array([features(t) for t in common.byte_texts(batch, text)])
                if isinstance(model, float):
                    worth, s = np.zeros(len(x)), np.full(len(x), model)
                else:
                    worth, s = model.worth(x), model.score(x)
                new = [pa.array(worth), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
                yield common.append(batch, new, ["worth", "score", "predicted"])

    return docs.mapInArrow(run, common.added(docs, "worth double, score double, predicted int"))
