"""Token counts by dynamic programming over prefixes of byte-pair encoded texts.

A text is split into words as the vocabulary's library does. In a word, the encoding of a
prefix ends in one token, and what stands before that token is the encoding of the shorter
prefix; so one table over all prefixes holds the last token and the number of tokens of each.
A token may follow another where no merge across their border comes before the merges that
use up the pieces at the border; that is decided from the two tokens alone. The counts at
all prefixes of a text are those of its words, shifted, except that a run of white space is
one word as long as nothing follows it.

``count_tokens`` gives the count at the last prefix and where a text must be cut to fit a
limit, and can store the counts of all prefixes (as differences, two bytes a character).
``tokens_at`` and ``longest_prefix`` answer questions from this column without encoding.
A longer prefix can have fewer tokens than a shorter one; cuts take the longest that fits.

Defined results: a missing or empty text has no bytes and no tokens; equal rows get equal
results; special strings of the vocabulary inside a text are one token each, cut off inside
they are ordinary text. Rows are read once, without a shuffle. Columns go through, but for
those named like a result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
# A worker forgets words and pairs of tokens beyond so many, and never keeps longer words.
REMEMBERED_WORDS = 400_000
REMEMBERED_PAIRS = 1_000_000
LONGEST_WORD = 64
# Long texts are taken in stretches of about so many characters.
STRETCH = 1 << 19

_NEVER = 1 << 40


def unsettled() -> str:
    """Letters and numerals newer than Python's own character tables, as ranges of a pattern.

    Libraries of different age split words at these differently.
    """
    import regex

    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    new = list(map(ord, regex.findall(r"[\p{L}\p{N}]", unknown)))
    ranges: list[list[int]] = []
    for c in new:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(rf"\U{a:08x}-\U{z:08x}" for a, z in ranges)


class Vocabulary:
    """Tokens and merges of a byte-level byte-pair vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, added = content["model"], content["added_tokens"]
        plain = content["normalizer"] is None and content["pre_tokenizer"]["type"] == "ByteLevel"
        if model["type"] != "BPE" or not plain or content["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"not a byte-level byte-pair vocabulary: {path}")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError(f"special strings with conditions: {path}")
        self.path = path
        self.special = sorted((a["content"] for a in added), key=len, reverse=True)
        # Printable bytes stand for themselves, the others for characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ids = model["vocab"]
        text = {name: bytes(map(byte_of.__getitem__, name)) for name in ids}
        # Of each left piece its right partners and the place of their merge.
        self.partners: dict[int, dict[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for at, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            whole = ids[a + b]
            self.partners.setdefault(ids[a], {})[ids[b]] = at
            self.parts.setdefault(whole, (ids[a], ids[b], at))
        # Tree of tokens: of each next byte the token that ends there, or -1, and what follows.
        self.tree: dict[int, list] = {}
        for name, number in ids.items():
            if len(text[name]) > 1 and number not in self.parts:
                continue
            below = self.tree
            for byte in text[name]:
                node = below.setdefault(byte, [-1, {}])
                below = node[1]
            node[0] = number
        self.edges: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, dict[int, bool]] = {}
        self.known_pairs = 0

    def edge(self, token: int, side: int) -> dict[int, tuple[int, int]]:
        """Pieces of a token at its left (0) or right (1) border, with the merges that make and use them."""
        known = self.edges[side].get(token)
        if known is None:
            known, piece, used = {}, token, _NEVER
            while piece in self.parts:
                made = self.parts[piece][2]
                known[piece] = (made, used)
                piece, used = self.parts[piece][side], made
            known[piece] = (-1, used)
            self.edges[side][token] = known
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' text is these two tokens."""
        left = self.edge(b, 0)
        for x, (made_x, used_x) in self.edge(a, 1).items():
            partners = self.partners.get(x)
            if partners:
                for y in partners.keys() & left.keys():
                    at, (made_y, used_y) = partners[y], left[y]
                    # Of equal merges the left one comes first.
                    if made_x < at < used_x and made_y < at <= used_y:
                        return False
        return True

    def prefixes(self, word: bytes) -> list[int]:
        """Number of tokens of each prefix of a word, from the empty one on."""
        last, count = [0] * (len(word) + 1), [0] * (len(word) + 1)
        for start in range(len(word)):
            before, more, below, end = last[start], count[start] + 1, self.tree, start
            fits = self.pairs.get(before)
            if fits is None:
                fits = self.pairs[before] = {}
            for byte in word[start:]:
                node = below.get(byte)
                if node is None:
                    break
                end += 1
                token, below = node
                if token >= 0 and not count[end]:
                    if start:
                        fit = fits.get(token)
                        if fit is None:
                            fit = fits[token] = self.follows(before, token)
                            self.known_pairs += 1
                        if not fit:
                            continue
                    last[end], count[end] = token, more
        if self.known_pairs > REMEMBERED_PAIRS:
            self.pairs, self.known_pairs = {}, 0
        return count


class Counter:
    """Counts at all prefixes of texts, remembering words already seen."""

    def __init__(self, path: str, newer: str):
        import public_tokenizers
        import regex

        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.newer = re.compile(f"[{newer}]") if newer else None
        # Most texts end their search at this plainer pattern.
        self.late = re.compile(f"[{newer[:10]}-\U0010ffff]") if newer else None
        self.special = re.compile("|".join(map(re.escape, self.vocabulary.special))) if self.vocabulary.special else None
        self.border = regex.compile(r"\S(?=\s)")
        self.run = regex.compile(r"\s\s+(?=\S)")
        self.sizes: dict[str, int] = {}
        self.shapes: dict[str, bytes] = {}
        self.library = None

    def words(self, text: str) -> list[str]:
        if self.newer and not text.isascii() and self.late.search(text) and self.newer.search(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.vocabulary.path).pre_tokenizer
            return [text[a:z] for _, (a, z) in self.library.pre_tokenize_str(text)]
        return self.split(text)

    def stretches(self, text: str) -> Iterator[str]:
        """A text in parts that end before white space, where words end in any case."""
        start = 0
        while len(text) - start > STRETCH:
            met = self.border.search(text, start + STRETCH)
            if met is None:
                break
            yield text[start : met.end()]
            start = met.end()
        yield text[start:]

    def learn(self, word: str) -> tuple[int, bytes]:
        data = word.encode()
        count = self.vocabulary.prefixes(data)
        if len(data) != len(word):
            # Where characters end: no byte that continues one comes next.
            count = [c for c, after in zip(count, data + b" ") if after & 0xC0 != 0x80]
        shape = array("h", [b - a for a, b in zip(count, count[1:])]).tobytes()
        if len(word) <= LONGEST_WORD:
            if len(self.sizes) >= REMEMBERED_WORDS:
                self.sizes.clear()
                self.shapes.clear()
            self.sizes[word], self.shapes[word] = count[-1], shape
        return count[-1], shape

    def size(self, words: list[str]) -> int:
        total, known = 0, self.sizes.get
        for word in words:
            size = known(word)
            total += self.learn(word)[0] if size is None else size
        return total

    def count(self, text: str) -> int:
        """Number of tokens of a text."""
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(self.size(self.words(s)) for p in parts for s in self.stretches(p))

    def _plain(self, text: str) -> np.ndarray:
        shapes = []
        for word in self.words(text):
            shapes.append(self.shapes.get(word) or self.learn(word)[1])
        total = np.cumsum(np.frombuffer(b"".join(shapes), np.int16), dtype=np.int64)
        # White space is one word up to its end as long as nothing follows.
        for met in self.run.finditer(text):
            a, z = met.span()
            total[z - 1] = (total[a - 1] if a else 0) + self.size([met.group()])
        return total

    def prefixes(self, text: str) -> np.ndarray:
        """Number of tokens of each prefix of 1, 2, ... characters of a text."""
        found, base, start = [], 0, 0
        marks = [m.span() for m in self.special.finditer(text)] if self.special else []
        for a, z in [*marks, (len(text), len(text) + 1)]:
            # A special string without its end is text like other text.
            stretch_base = base
            for s in self.stretches(text[start : z - 1]):
                if s:
                    found.append(self._plain(s) + stretch_base)
                    stretch_base = int(found[-1][-1])
            if a < len(text):
                base += self.count(text[start:a]) + 1
                found.append(np.array([base]))
            start = z
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def counter(vocabulary: str | None, newer: str) -> Counter:
    import public_tokenizers

    return Counter(vocabulary or public_tokenizers.path(VOCABULARY), newer)


def fitting(counts: np.ndarray, budget: int) -> int:
    """Length of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


RESULTS = "n_bytes long, n_tokens long, over_limit boolean, fitting_chars long"
STORED = "prefix_steps"


def count_tokens(
    docs: DataFrame, text: str = "text", limit: int = LIMIT, store: bool = False, vocabulary: str | None = None
) -> DataFrame:
    """Documents with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fitting_chars``.

    ``fitting_chars`` is the length of the longest prefix within the limit. ``store`` adds
    ``prefix_steps``: for each character by how much it changes the number of tokens, as
    little-endian 16-bit numbers.
    """
    new = RESULTS + (f", {STORED} binary" if store else "")
    names = [part.split()[0] for part in new.split(", ")]
    keep = common.carried(docs, names)
    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), *[f"`{c}`" for c in keep])
    newer = unsettled()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = counter(vocabulary, newer)
        for whole in batches:
            for batch in common.chunks(whole, "_text"):
                sizes, totals, over, fits, steps = [], [], [], [], []
                for document in common.texts(batch, "_text"):
                    sizes.append(len(document.encode()))
                    # A token has at least one byte, so short texts are within the limit.
                    counts = counting.prefixes(document) if store or sizes[-1] > limit else None
                    total = counting.count(document) if counts is None else int(counts[-1]) if len(counts) else 0
                    totals.append(total)
                    over.append(total > limit)
                    fits.append(fitting(counts, limit) if total > limit else len(document))
                    if store:
                        steps.append(np.diff(counts, prepend=0).astype("<i2").tobytes())
                columns = [
                    pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(over, pa.bool_()), pa.array(fits, pa.int64()),
                    *([pa.array(steps, pa.binary())] if store else []),
                ]
                kept = batch.select(keep)
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*keep, *names])

    return source.mapInArrow(run, common.added(docs.select(*[f"`{c}`" for c in keep]), new))


def _asked(stored: DataFrame, question: str, result: str, answer) -> DataFrame:
    keep = common.carried(stored, [result])
    source = stored.select(*[f"`{c}`" for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for steps, asked in zip(batch.column(STORED).to_pylist(), batch.column(question).to_pylist()):
                counts = np.cumsum(np.frombuffer(steps or b"", "<i2"), dtype=np.int64)
                found.append(None if asked is None else answer(counts, asked))
            yield common.append(batch, [pa.array(found, pa.int64())], [result])

    return source.mapInArrow(run, common.added(source, f"{result} long"))


def tokens_at(stored: DataFrame, position: str, result: str = "tokens_at") -> DataFrame:
    """Tokens of the prefix of so many characters as column ``position`` says, from the stored counts.

    Positions below 0 count as 0, those beyond the text as its end; a missing one gives null.
    """
    return _asked(stored, position, result, lambda counts, p: int(counts[min(p, len(counts)) - 1]) if p > 0 and len(counts) else 0)


def longest_prefix(stored: DataFrame, budget: str, result: str = "prefix_chars") -> DataFrame:
    """Characters of the longest prefix within the tokens of column ``budget``, from the stored counts."""
    return _asked(stored, budget, result, fitting)
