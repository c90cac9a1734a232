"""Secret scan: candidate strings judged by a random forest.

Candidates are runs of at least 16 characters that keys and tokens are made of, and any
value of at least 6 characters without a blank that is assigned to a name like that of a
secret, whatever marks it holds. Where confirmed candidates overlap, all of them is one
secret. Features are the candidate's length, its mix of characters and their transitions, how far words of a
dictionary cover it, how far it looks like a path, and the words beside it. The forest is
trained on labelled findings and removes the false ones. The dictionary is the corpus's
most frequent words, counted over all documents; its size is fixed.

``labelled_findings`` makes findings by public formats (keys, tokens, passwords; digests,
identifiers, paths, long words) from a seed; findings of one's own replace or extend them.

Defined results: a missing or empty text has no candidates and, when redacted, stays as it
is; equal rows get equal results; without findings of both kinds nothing is confirmed.
Columns of the documents go through, but for those named like a result.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.~-])[A-Za-z0-9+/_.~-]{16,}={0,2}")
# A name like a secret's and a sign of assignment; the value begins where it ends.
NAMED = re.compile(
    r"(?i)(?:token|secret|passw|passphrase|\bpass\b|pwd|api[ _-]?key|auth|bearer|credential|private[ _-]?key|access[ _-]?key)"
    r"[a-z0-9_.-]{0,20}\\?[\"']?\s{0,3}[=:]{1,2}>?\s{0,3}(?:(?:bearer|basic)\s{1,3})?\\?"
)
# In quotes up to the same one, after a quote that is not closed up to any, or up to a blank.
VALUE = re.compile(r"\"([^\"\s]{6,})\"|'([^'\s]{6,})'|[\"']([^\s\"']{6,})|([^\s\"']\S{5,})")
SHORTEST = 6
BEFORE, AFTER = 40, 16
DICTIONARY_WORDS = 4000
TREES, DEPTH, LEAF, BINS = 40, 8, 4, 32
MASK = "[secret]"

_SECRET_WORD = re.compile(r"(?i)token|secret|passw|passphrase|\bpass\b|pwd|api[ _-]?key|auth|bearer|credential|private|access[ _-]?key")
_BENIGN_WORD = re.compile(r"(?i)commit|sha\d*|md5|uuid|guid|digest|hash|checksum|revision|version|etag|example|sample|file|path|image|page")
_ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
_EXTENSION = re.compile(r"\.[a-z]{2,4}$")
_CODE = re.compile(r"^[$<{%*]|[(\[]|^[a-z_]+(\.[a-z_]+)+$")
_PREFIX = re.compile(r"^(AKIA|ASIA|gh[pousr]_|sk[-_]|xox[abp]-|eyJ|AIza|glpat-)")

FEATURES = (
    "length", "log_length", "digits", "upper", "lower", "marks", "hexadecimal", "transitions", "distinct",
    "entropy", "dictionary", "letter_pairs", "slashes", "dots", "dashes", "extension", "prefix", "longest_run",
    "secret_word", "benign_word", "assigned", "quoted", "address", "kinds", "code",
)


@dataclass
class Dictionary:
    """Words, and log probabilities of their letter pairs."""

    words: frozenset[str]
    pairs: dict[str, float]

    @classmethod
    def of(cls, words: list[str]) -> Dictionary:
        seen = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
        total = sum(seen.values()) + 676
        return cls(frozenset(words), {p: math.log((c + 1) / total) for p, c in seen.items()})

    def coverage(self, text: str) -> float:
        """Share of the letters in words of three to twelve letters, taken from the left, longest first."""
        text, at, inside = text.lower(), 0, 0
        while at < len(text):
            for size in range(min(12, len(text) - at), 2, -1):
                if text[at : at + size] in self.words:
                    inside += size
                    at += size
                    break
            else:
                at += 1
        return inside / max(1, len(text))

    def likelihood(self, text: str) -> float:
        letters = re.sub("[^a-z]", "", text.lower())
        if len(letters) < 2:
            return -10.0
        low = math.log(1 / (sum(1 for _ in self.pairs) + 676)) if self.pairs else -6.5
        return sum(self.pairs.get(letters[i : i + 2], low) for i in range(len(letters) - 1)) / (len(letters) - 1)


def features(found: str, before: str, after: str, known: Dictionary) -> list[float]:
    n = len(found)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in found]
    count = Counter(kinds)
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    longest = run = 1
    for a, b in zip(kinds, kinds[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    shares = [c / n for c in Counter(found).values()]
    return [
        min(n, 200),
        math.log(n),
        count["d"] / n,
        count["u"] / n,
        count["l"] / n,
        count["m"] / n,
        float(all(c in "0123456789abcdefABCDEF" for c in found)),
        changes / (n - 1),
        len(shares) / n,
        -sum(s * math.log2(s) for s in shares),
        known.coverage(found),
        known.likelihood(found),
        found.count("/") / n * 10,
        found.count(".") / n * 10,
        (found.count("-") + found.count("_")) / n * 10,
        float(bool(_EXTENSION.search(found))),
        float(bool(_PREFIX.match(found))),
        longest / n,
        float(bool(_SECRET_WORD.search(before))),
        float(bool(_BENIGN_WORD.search(before))),
        float(bool(_ASSIGNED.search(before))),
        float(before[-1:] in ("'", '"') and after[:1] in ("'", '"')),
        float("://" in before[-12:] or found.startswith("//")),
        len(count),
        float(bool(_CODE.search(found))),
    ]


class Tree:
    """A decision tree over binned features; nodes are rows of arrays."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, rng: np.random.Generator):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []
        self._grow(bins, y, np.arange(len(y)), 0, rng)

    def _grow(self, bins: np.ndarray, y: np.ndarray, rows: np.ndarray, depth: int, rng: np.random.Generator) -> int:
        here = len(self.value)
        for column, start in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0)):
            column.append(start)
        self.value.append(float(y[rows].mean()))
        if depth == DEPTH or len(rows) < 2 * LEAF or self.value[here] in (0.0, 1.0):
            return here
        best = (1e-9, -1, 0)
        for f in rng.choice(bins.shape[1], max(1, round(bins.shape[1] ** 0.5)), replace=False):
            n = np.cumsum(np.bincount(bins[rows, f], minlength=BINS))[:-1]
            ones = np.cumsum(np.bincount(bins[rows, f], y[rows], minlength=BINS))[:-1]
            total, all_ones = len(rows), y[rows].sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = ones**2 / n + (all_ones - ones) ** 2 / (total - n) - all_ones**2 / total
            gain = np.where((n >= LEAF) & (total - n >= LEAF), gain, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), int(f), k)
        if best[1] >= 0:
            low = bins[rows, best[1]] <= best[2]
            self.feature[here], self.cut[here] = best[1], best[2]
            self.left[here] = self._grow(bins, y, rows[low], depth + 1, rng)
            self.right[here] = self._grow(bins, y, rows[~low], depth + 1, rng)
        return here

    def freeze(self) -> Tree:
        for name in ("feature", "cut", "left", "right", "value"):
            setattr(self, name, np.array(getattr(self, name)))
        return self

    def predict(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for _ in range(DEPTH):
            f = self.feature[node]
            low = bins[np.arange(len(bins)), np.maximum(f, 0)] <= self.cut[node]
            node = np.where(f < 0, node, np.where(low, self.left[node], self.right[node]))
        return self.value[node]


class Forest:
    """Trees on bootstrap samples; the mean of their leaves is the probability of a secret."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 13):
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        bins, rng = self.binned(x), np.random.default_rng(seed)
        self.trees = []
        for _ in range(TREES):
            rows = rng.integers(0, len(y), len(y))
            self.trees.append(Tree(bins[rows], y[rows], rng).freeze())

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        return sum(t.predict(bins) for t in self.trees) / len(self.trees)


def frequent_words(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of three to twelve ASCII letters, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, "text"):
                held: Counter[str] = Counter()
                for document in common.texts(batch):
                    held.update(document.split())
                held = {w: c for w, c in held.items() if 3 <= len(w) <= 12 and w.isascii() and w.islower() and w.isalpha()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "c"]
                )

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, c long")
    top = found.groupBy("word").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def labelled_findings(words: list[str], n: int = 2400, seed: int = 31) -> list[tuple[str, str, str, int]]:
    """(candidate, text before, text after, 1 for a secret) in equal parts, by public formats."""
    rng = random.Random(seed)
    words = words or ["the", "and", "for", "with", "from", "page"]
    upper, lower, digits, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    phrase = lambda k: " ".join(rng.choice(words) for _ in range(k))

    def password() -> str:
        word, number = rng.choice(words), some(digits, rng.randint(2, 4))
        out = rng.choice((
            lambda: word + number, lambda: word.capitalize() + number + rng.choice("!?#$@%&*"),
            lambda: word.capitalize() + rng.choice("!@#$%-_.") + number, lambda: number + word + rng.choice(words).capitalize(),
            lambda: some(upper + lower + digits, rng.randint(8, 15)), lambda: some(lower + digits, rng.randint(8, 15)),
            lambda: some(hexa, rng.randint(8, 15)), lambda: some(upper + lower + digits + "!@#$%^&*+-_=?.", rng.randint(7, 24)),
        ))()
        return out + some(digits, max(0, SHORTEST - len(out)))

    def plain_value() -> str:
        word, two = rng.choice(words), rng.choice(words)
        out = rng.choice((
            lambda: word, lambda: word + two, lambda: word.capitalize(), lambda: f"{word}_{two}", lambda: f"{word}-{two}",
            lambda: f"{word}.{two}", lambda: f"get_{word}()", lambda: f"{word}({two})", lambda: f"{word}.{two}[0]",
            lambda: "$" + word.upper(), lambda: "${" + word.upper() + "}", lambda: f"<{word}-{two}>", lambda: "{{" + word + "}}",
            lambda: "*" * rng.randint(6, 12), lambda: "x" * rng.randint(6, 12), lambda: f"{word.upper()}_{two.upper()}",
            lambda: f"{word}/{two}",
        ))()
        return out if len(out) >= SHORTEST else out + rng.choice(words) * SHORTEST

    out = []
    names = ("token", "secret", "api_key", "apikey", "password", "passwd", "auth_token", "access_key", "private_key", "TOKEN", "API_KEY", "Authorization")
    signs = ((' = "', '"'), (": ", ""), ("=", ""), (': "', '",'), (" = '", "'"), (": Bearer ", ""))
    for i in range(n // 2):
        if i % 3 == 0:
            # Short or marked passwords and values that are none, under the same names.
            for value, is_secret in ((password(), 1), (plain_value(), 0)):
                name = rng.choice((*names, "pwd", "pass", "PASSWORD", "db_password"))
                left, right = rng.choice(signs[:5])
                out.append((value, f"{phrase(4)} {name}{left}"[-BEFORE:], f"{right} {phrase(3)}"[:AFTER], is_secret))
            continue
        secret = rng.choice((
            lambda: some(hexa, rng.choice((32, 40, 64))), lambda: "AKIA" + some(upper + digits, 16),
            lambda: "ghp_" + some(upper + lower + digits, 36), lambda: "sk-" + some(upper + lower + digits, 40),
            lambda: some(upper + lower + digits + "+/", 40), lambda: some(upper + lower + digits + "_-", rng.randint(16, 48)),
        ))()
        name = rng.choice(names)
        left, right = rng.choice(signs)
        if _PREFIX.match(secret) and rng.random() < 0.3:
            name, left, right = "", "", ""
        out.append((secret, f"{phrase(4)} {name}{left}"[-BEFORE:], f"{right} {phrase(3)}"[:AFTER], 1))
        kind = rng.randrange(7)
        before, after = phrase(5) + " ", " " + phrase(3)
        if kind == 0:
            fake, before = some(hexa, rng.choice((32, 40, 64))), phrase(2) + rng.choice((" commit ", " sha256: ", " md5 ", " checksum = ", " revision ", ' etag: "', " digest "))
        elif kind == 1:
            fake, before = "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12)), phrase(2) + rng.choice((" uuid ", " id = ", " "))
        elif kind == 2:
            fake, before = "/".join(rng.choice(words) for _ in range(5)) + rng.choice((".html", ".py", "", ".txt")), phrase(2) + rng.choice((" https://", " path ", " "))
        elif kind == 3:
            fake = some(digits, rng.randint(16, 20))
        elif kind == 4:
            fake, before = "_".join(rng.choice(words) for _ in range(4)), phrase(2) + rng.choice((" token = ", " key: ", " name = ", " "))
        else:
            fake = "".join(rng.choice(words) for _ in range(rng.randint(4, 7)))
        fake = fake.ljust(16, "e")
        out.append((fake, before[-BEFORE:], after[:AFTER], 0))
    return out


def train(findings: list[tuple[str, str, str, int]], known: Dictionary) -> Forest | None:
    """A forest from labelled findings; none without both kinds."""
    if len({f[3] for f in findings}) < 2:
        return None
    x = np.array([features(c, b, a, known) for c, b, a, _ in findings])
    return Forest(x, np.array([f[3] for f in findings], float))


def candidates(body: str) -> list[tuple[int, int]]:
    """Spans of the runs and of the assigned values, in order; they can overlap."""
    found = {m.span() for m in CANDIDATE.finditer(body)}
    for m in NAMED.finditer(body):
        value = VALUE.match(body, m.end())
        if value:
            a, z = value.span(value.lastindex)
            # What ends a sentence or an entry is no part of a bare value.
            z -= len(body[a:z]) - len(body[a:z].rstrip(".,;\"'")) if value.lastindex > 2 else 0
            if z - a >= SHORTEST:
                found.add((a, z))
    return sorted(found)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def scan(docs: DataFrame, forest: Forest | None, known: Dictionary, text: str = "text") -> DataFrame:
    """Documents with ``n_candidates``, ``secrets`` (character spans) and the ``redacted`` text."""
    names = ["n_candidates", "secrets", "redacted"]
    keep = common.carried(docs, names)
    docs = docs.select(*[f"`{c}`" for c in keep])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, text):
                bodies = batch.column(text).to_pylist()
                row, at, x = [], [], []
                for i, body in enumerate(bodies):
                    for a, z in candidates(body or ""):
                        row.append(i)
                        at.append((a, z))
                        x.append(features(body[a:z], body[max(0, a - BEFORE) : a], body[z : z + AFTER], known))
                p = forest.probability(np.array(x)) if x and forest else np.zeros(len(x))
                counts = np.bincount(np.array(row, np.int64), minlength=len(bodies))
                sure_of: list[list[tuple[int, int]]] = [[] for _ in bodies]
                for i, span_, sure in zip(row, at, p):
                    if sure >= 0.5:
                        sure_of[i].append(span_)
                spans = [[{"start": a, "end": z} for a, z in merged(found)] for found in sure_of]
                clean = list(bodies)
                for i, found in enumerate(spans):
                    for s in reversed(found):
                        clean[i] = clean[i][: s["start"]] + MASK + clean[i][s["end"] :]
                new = [pa.array(counts), pa.array(spans, span), pa.array(clean, pa.string())]
                yield common.append(batch, new, names)

    added = "n_candidates long, secrets array<struct<start:int,end:int>>, redacted string"
    return docs.mapInArrow(run, common.added(docs, added))


def find_secrets(docs: DataFrame, findings: list[tuple[str, str, str, int]] | None = None) -> DataFrame:
    """The whole way: dictionary, forest, scan."""
    words = frequent_words(docs)
    known = Dictionary.of(words)
    forest = train(labelled_findings(words) if findings is None else findings, known)
    return scan(docs, forest, known)


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        "n_candidates",
        F.size("secrets").cast("long").alias("n_secrets"),
        F.array_join(F.transform("secrets", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("spans"),
        F.crc32(F.coalesce("redacted", F.lit("")).cast("binary")).alias("redacted_crc32"),
    )
