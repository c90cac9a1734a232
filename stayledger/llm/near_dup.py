"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

A document's set holds its distinct five-word shingles, as 64-bit hashes. One permutation of
the 32-bit numbers scatters the set; a second one, shifted circularly by 0, 1, 2 and so on,
gives all coordinates of its signature. Bands of ``ROWS`` coordinates are bucket keys. At
the similarity asked for, a pair misses all of the ``BANDS`` buckets with a chance below 1 in
a million; whatever meets in a bucket is judged by the exact similarity of the full sets.

Equal sets are one class, so copies are never compared. A bucket is not expanded into
pairs. First it is compared with one centre, the document that shares most with others;
this links most near copies. A bucket is done when all of it is connected. The documents of
the other buckets form clusters, connected by buckets, and a cluster is dealt into blocks of
about ``BLOCK`` documents; two blocks at a time are compared in one task by the product of
their shingle incidence, and only links that connect two components leave the task. Blocks
of one and the same component are not compared. There is no cap, and no list of pairs.

Components come from alternating star contractions; labels and links stay distributed.
Results between rounds are tables in the shared folder.

Defined results: a document without words has no set and is linked with nothing; one with
fewer than five words has its whole sequence as its only shingle; equal documents are in one
component, of which the one with the smallest id is kept; rows that repeat an id are
judged each by its own text, and of those in one component the ones equal to the root's set
are kept; a row without an id is linked with nothing, has no component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common
from stayledger.storage import stage_table

SHINGLE = 5
PERCENT = 75
# A pair at 75 per cent misses all buckets with a chance of (1 - 0.75 ** 5) ** 56, 3 in 10 million.
BANDS, ROWS = 56, 5
BLOCK = 200
# Columns of shingles that are multiplied at once.
COLUMNS = 4096
CHUNK_BYTES = 2 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U64(30))) * _U64(_ODD[0])
    x = (x ^ (x >> _U64(27))) * _U64(_ODD[1])
    return x ^ (x >> _U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(1, n), np.uint64)
    done, step = 1, base
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * _U64(step)
        step = step * step % (1 << 64) if take == done else step
        done += take
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the number of words before each text (and after all)."""
    body = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    word = ~_BLANK[body]
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    start = np.r_[0, start] if word[0] else start
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    total = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + _U64(1)) * powers(_BASE, len(body)), out=total[1:])
    value = (total[end] - total[start]) * powers(_INVERSE, len(body))[start]
    value = mixed(value ^ ((end - start).astype(np.uint64) * _U64(_ODD[2])))
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return value, np.searchsorted(start, first)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    value, first = word_hashes(texts)
    n = len(value)
    run = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        run[: max(0, n - k)] += value[k:] * _U64(_ODD[k])
    run = mixed(run)
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= SHINGLE:
            out.append(np.unique(run[a : z - SHINGLE + 1]))
        elif z > a:
            # The whole sequence is the one shingle; its length tells it from longer ones.
            odd = np.array(_ODD[: z - a], np.uint64)
            whole = (value[a:z] * odd).sum(dtype=np.uint64) + _U64(z - a)
            out.append(mixed(mixed(np.array([whole], np.uint64))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def permuted(x: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(x, np.uint32(shift), out=scratch)
        np.bitwise_xor(x, scratch, out=x)
        if factor is not None:
            np.multiply(x, np.uint32(factor), out=x)
    return x


def signatures(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``size`` minima per set, none of which may be empty."""
    lengths = np.array([len(s) for s in sets])
    starts = np.cumsum(lengths) - lengths
    every = np.concatenate(sets)
    scratch = np.empty(len(every), np.uint32)
    # The first permutation scatters the set; the second is shifted once per coordinate.
    scattered = permuted((every ^ (every >> _U64(32))).astype(np.uint32) ^ np.uint32(0x5BD1E995), scratch)
    out, moved = np.empty((len(sets), size), np.uint32), np.empty_like(scattered)
    for k in range(size):
        np.add(scattered, np.uint32(k), out=moved)
        out[:, k] = np.minimum.reduceat(permuted(moved, scratch), starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    wide = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.zeros((len(signature), BANDS), np.uint64)
    for j in range(ROWS):
        key = mixed(key + (wide[:, :, j] + _U64(1)) * _U64(_ODD[j]))
    return mixed(key + np.arange(1, BANDS + 1, dtype=np.uint64) * _U64(_BASE)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: hash of its text, size of its set, two sums that tell sets apart, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, "text", CHUNK_BYTES):
                sets = shingle_sets(common.byte_texts(batch))
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                keys = [None] * len(sets)
                sums = np.zeros((2, len(sets)), np.int64)
                if len(some):
                    full = [sets[i] for i in some]
                    for i, row in zip(some.tolist(), band_keys(signatures(full))):
                        keys[i] = row
                    for i, s in zip(some.tolist(), full):
                        sums[0, i] = mixed(s).sum(dtype=np.uint64).astype(np.int64)
                        sums[1, i] = mixed(s ^ _U64(_BASE)).sum(dtype=np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(["doc_id", "body"]).columns, pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "body", "n_shingles", "sum_a", "sum_b", "bands"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, body long, n_shingles long, sum_a long, sum_b long, bands array<long>"
    return docs.select("doc_id", "body", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame) -> DataFrame:
    """``rep`` and its shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.chunks(whole, "text", CHUNK_BYTES):
                sets = [s.tobytes() for s in shingle_sets(common.byte_texts(batch))]
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, pa.binary())], ["rep", "shingles"])

    id_type = docs.schema["rep"].dataType.simpleString()
    return docs.mapInArrow(run, f"rep {id_type}, shingles binary")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b").mapInArrow(run, pairs.schema)


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of the links (a, b): columns ``node``, ``root``."""
    edges = links.select("a", "b").where("a <> b")
    while True:
        mirrored = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = mirrored.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = mirrored.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # Every edge now points to a smaller node.
        large = stage_table(large.where("a <> b").distinct(), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stage_table(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "stars")
        # Done when no root points on: then each node has one edge, to its root.
        if edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


LABEL = ["n_shingles", "sum_a", "sum_b"]


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row its id, ``body`` (hash of its text), the ``LABEL`` of its class, component and ``kept``.

    A class is named by its smallest id and a hash of its label, as an id can repeat with other texts.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    sketch = stage_table(sketches(rows), "sketches")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    first = full.groupBy(*LABEL).agg(F.min(F.struct("doc_id", "body")).alias("first"), F.first("bands").alias("bands"))
    rep = F.struct(F.col("first.doc_id").alias("doc_id"), F.xxhash64(*LABEL).alias("k")).alias("rep")
    classes = stage_table(first.select(*LABEL, rep, F.col("first.body").alias("body"), "bands"), "classes")
    root = _roots(rows, classes, percent)
    names = classes.select(*LABEL, "rep")
    placed = full.select("doc_id", "body", *LABEL).join(names, LABEL).join(root, F.col("rep") == F.col("node"), "left")
    placed = placed.withColumn("root", F.coalesce("root", "rep"))
    kept = (F.col("rep") == F.col("root")) & (F.col("doc_id") == F.col("root.doc_id"))
    placed = placed.select("doc_id", "body", *LABEL, F.col("root.doc_id").alias("component_id"), kept.alias("kept"))
    alone = sketch.where("n_shingles = 0 or doc_id is null")
    alone = alone.select("doc_id", "body", *LABEL, F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return placed.unionByName(alone)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row."""
    return judged(docs, doc_id, text, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _roots(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Root of every class that is linked with another."""
    banded = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = stage_table(banded.join(shared, "key"), "buckets")
    # A document in many large buckets is like many others: a good centre.
    hubs = stage_table(met.groupBy("rep").agg(F.sum("m").alias("hub")), "hubs")
    # A row of each class: equal rows have equal sets.
    chosen = classes.join(hubs, "rep", "left_semi").select("rep", F.col("rep.doc_id").alias("doc_id"), "body")
    texts = rows.join(chosen, ["doc_id", "body"])
    sets = stage_table(full_sets(texts.select("rep", "text")).dropDuplicates(["rep"]), "sets")

    ranked = met.join(hubs, "rep")
    top = ranked.groupBy("key").agg(F.max(F.struct("hub", "rep", "n")).alias("top"))
    first = top.select("key", F.col("top.rep").alias("c"), F.col("top.n").alias("c_n"))
    pair = [F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")]
    centred = met.join(first, "key").where("rep <> c")
    fits = F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent
    pairs = stage_table(centred.where(fits).select(*pair).distinct(), "pairs")
    tested = stage_table(linked(pairs, sets, percent), "linked")
    root = components(tested)

    # Buckets that more than one component has a part in.
    label = F.coalesce("root", "rep").alias("comp")
    placed = met.join(root, F.col("rep") == F.col("node"), "left").select("key", "rep", label)
    parts = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("rep").alias("b"))
    open_ = stage_table(placed.join(parts.where("low < high").select("key", "b"), "key"), "open")
    if open_.isEmpty():
        return root
    more = stage_table(_links_in_clusters(open_, sets, percent), "cluster-links")
    if more.isEmpty():
        return root
    return components(more.unionByName(root.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _links_in_clusters(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components whose members share open buckets."""
    joined = components(open_.select(F.col("rep").alias("a"), "b").where("a <> b").distinct())
    members = open_.select("rep", "comp").distinct().join(joined, F.col("rep") == F.col("node"), "left")
    members = members.select("rep", "comp", F.coalesce("root", "rep").alias("cluster"))
    # Blocks: a large component has its own, small ones share.
    size = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n_comp"))
    large = F.col("n_comp") >= BLOCK
    rest = size.groupBy("cluster").agg(F.sum(F.when(~large, F.col("n_comp")).otherwise(0)).alias("n_small"))
    of = lambda n: F.ceil(F.col(n) / BLOCK)
    part = F.when(large, F.pmod(F.xxhash64("rep"), of("n_comp"))).otherwise(F.pmod(F.xxhash64("comp"), of("n_small")))
    block = F.struct(F.when(large, F.col("comp")).alias("pure"), part.alias("part")).alias("block")
    placed = members.join(size, ["cluster", "comp"]).join(rest, "cluster")
    placed = stage_table(placed.select("rep", "comp", "cluster", block), "blocks")
    blocks = placed.select("cluster", "block").distinct()
    one, two = blocks.withColumnRenamed("block", "one"), blocks.withColumnRenamed("block", "two")
    apart = "one.pure is null or two.pure is null or one.pure <> two.pure"
    work = one.join(two, "cluster").where("one <= two").where(apart)
    sides = F.explode(F.array_distinct(F.array("one", "two"))).alias("block")
    work = work.select("cluster", F.xxhash64("cluster", "one", "two").alias("task"), sides)
    rows = placed.join(work, ["cluster", "block"]).join(sets, "rep").select("task", "rep", "comp", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        found = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        name = [tuple(c.values()) for c in group.column("comp").to_pylist()]
        names = sorted(set(name))
        code_of = {c: i for i, c in enumerate(names)}
        comp = np.array([code_of[c] for c in name])
        n = np.array([len(x) for x in found])
        row = np.repeat(np.arange(len(found)), n)
        _, code, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        # Shingles of one document alone add nothing.
        keep = times[code] > 1
        row, code = row[keep], (np.cumsum(times > 1) - 1)[code[keep]]
        shared = np.zeros((len(found), len(found)), np.float32)
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        for first in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
            a, z = np.searchsorted(code, [first, first + COLUMNS])
            matrix = np.zeros((len(found), COLUMNS), np.float32)
            matrix[row[a:z], code[a:z] - first] = 1
            shared += matrix @ matrix.T
        good = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
        x, y = np.nonzero(good & (comp[:, None] > comp[None, :]))
        pairs = sorted(set(zip(comp[x].tolist(), comp[y].tolist())))
        kind = group.schema.field("comp").type
        fields = [f.name for f in kind]
        side = lambda k: pa.array([dict(zip(fields, names[p[k]])) for p in pairs], kind)
        return pa.table([side(0), side(1)], ["a", "b"])

    id_type = rows.schema["comp"].dataType.simpleString()
    return rows.groupBy("task").applyInArrow(compare, f"a {id_type}, b {id_type}").distinct()
