"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark's items: ten consecutive words, or the whole item
where it has fewer. Per pattern length there is one searcher: a shift table over blocks of
two words says how far the search may jump, buckets by the last block select the patterns
that may end there, and comparing all words confirms an occurrence.

Defined results: a missing or empty text has no words and no hits; an item without words has
no window; items with equal windows all count; rows may repeat. Columns of the documents go
through, but for those named like a result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common
from stayledger.storage import stage_table

WINDOW = 10
BLOCK_WORDS = 2
# Benchmark text searched for in one pass; more is searched for in further passes.
PASS_BYTES = 16 << 20

# Letters, digits and all non-ASCII bytes are words, A-Z in lower case; the rest divides.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

RESULT = (
    "n_words long, n_hit long, hit_spans array<struct<first:int,last:int>>, items array<string>"
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """Search for many word sequences of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(BLOCK_WORDS, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], int]]] = defaultdict(list)
        for number, pattern in enumerate(patterns):
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            self.bucket[pattern[length - self.block :]].append((pattern, number))

    def find(self, text: list[bytes]) -> Iterator[tuple[int, int]]:
        """(end of the occurrence, number of the pattern) for all occurrences, from left to right."""
        shift, jump, block, length = self.shift, self.jump, self.block, self.length
        end, n = length, len(text)
        while end <= n:
            last = tuple(text[end - block : end])
            step = shift.get(last, jump)
            if step:
                end += step
                continue
            seen = tuple(text[end - length : end])
            for pattern, number in self.bucket[last]:
                if pattern == seen:
                    yield end, number
            end += 1


class Matcher:
    """All windows of a set of items, one searcher for each length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, text in items:
            found = words(text)
            size = min(window, len(found))
            for i in range(len(found) - size + 1 if size else 0):
                # Without an id it is searched for, but names no item.
                owners[tuple(found[i : i + size])].update([] if item is None else [item])
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        self.searchers = [
            (WuManber(patterns, length), [sorted(owners[p]) for p in patterns])
            for length, patterns in sorted(by_length.items())
        ]

    def match(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (first word, last word) of the occurrences, and the items they belong to."""
        spans, items = [], set()
        for searcher, owners in self.searchers:
            for end, number in searcher.find(text):
                spans.append((end - searcher.length, end - 1))
                items.update(owners[number])
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _search(docs: DataFrame, items: list[tuple[str, bytes]], text: str, window: int) -> DataFrame:
    names = ["n_words", "n_hit", "hit_spans", "items"]
    again = set(names) <= set(docs.columns)
    base = docs.drop("n_words", "n_hit") if again else docs
    keep = [c for c in base.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, window)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.list_(pa.string())]
        for whole in batches:
            for batch in common.chunks(whole, text):
                rows: list[list] = [[], [], [], []]
                before = (
                    zip(batch.column("hit_spans").to_pylist(), batch.column("items").to_pylist())
                    if again
                    else (([], []) for _ in range(batch.num_rows))
                )
                for document, (old_spans, old_items) in zip(common.byte_texts(batch, text), before):
                    found = words(document)
                    spans, matched = matcher.match(found)
                    spans = merged(spans + [(s["first"], s["last"]) for s in old_spans])
                    rows[0].append(len(found))
                    rows[1].append(sum(last - first + 1 for first, last in spans))
                    rows[2].append([{"first": a, "last": b} for a, b in spans])
                    rows[3].append(sorted(matched | set(old_items)))
                new = [pa.array(values, kind) for values, kind in zip(rows, kinds)]
                yield common.append(batch.select(keep), new, names)

    return base.mapInArrow(run, common.added(base.select(*[f"`{c}`" for c in keep]), RESULT))


def find_benchmark_text(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Documents with their number of words, hit words, hit spans and the items found.

    The benchmark is dealt into blocks of about ``pass_bytes``; each is sent to all
    executors and searched for in one pass over the documents, without a shuffle. Between
    passes the documents with their finds so far are kept in the shared folder. Passages of
    an item without an id are hits, but no item is named for them.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("body")
    ).where("body is not null")
    size = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(size / pass_bytes))
    out = docs.select(*[f"`{c}`" for c in common.carried(docs, ["n_words", "n_hit", "hit_spans", "items"])])
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        rows = [(r["item"], bytes(r["body"])) for r in part.collect()]
        if block:
            out = stage_table(out, "decontaminate")
        out = _search(out, rows, text, window)
    return out


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts, the digest of its items' ids, and the verdict."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
