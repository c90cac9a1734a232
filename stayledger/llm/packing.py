"""Packing of documents into fixed-length sequences: first-fit decreasing in random groups.

Every document becomes its token ids and an end id. It is cut into pieces of the sequence
length and a rest. A seeded hash of the document's id deals the pieces into groups small
enough for one task's memory; each group packs its pieces alone, the longest first, each
into the first sequence with room. A tournament tree over the open sequences' room finds
that sequence in logarithmic time.

Ids are those of the ``tokenizers`` file ``byte_bpe_50k.json``; ``tiktoken`` computes them
from the same vocabulary several times faster, and the tests hold the two against each other.
The end mark in a text is that file's special token, as by the library's default.

Defined results: a missing or empty text is its end id alone; equal rows are packed each for
itself, in any order among themselves; a document without an id is packed like others. Only
the id and the text of the documents are used.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

SEQUENCE = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"
# Text that one group packs: its ids take about as much memory.
GROUP_BYTES = 16 << 20
# Sequence numbers of a group start at a multiple of this.
GROUP_STRIDE = 1 << 32


class Rooms:
    """Tournament tree of the room left in each bin; the leftmost bin with enough room wins."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """Put ``size`` into the first bin that has room for it, and say which."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        most[node] -= size
        leaf = node - self.leaves
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
        return leaf


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items come in the order they are to be placed in."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = lengths == room
    bins[full] = np.arange(full.sum())
    rest = np.flatnonzero(~full)
    rooms, used = Rooms(len(rest), room), [0] * len(rest)
    for i in rest.tolist():
        size = int(lengths[i])
        bin_ = rooms.take(size)
        bins[i], offsets[i] = bin_ + int(full.sum()), used[bin_]
        used[bin_] += size
    return bins, offsets


# Fixed value: the special string of the vocabulary and its id.
SPECIAL = {"<|endoftext|>": 50256}


def encoder(path: str | None = None):
    """A function from a text to its ids as a numpy array."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )
    return lambda text: encoding.encode(text, allowed_special="all")


def tokenise(docs: DataFrame, text: str, end_id: int, length: int, path: str | None) -> DataFrame:
    """Pieces of at most ``length`` ids: key, start, length, the document's ids in all, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for batch in common.chunks(whole, text):
                row, start, size, total, ids = [], [], [], [], []
                for i, document in enumerate(common.texts(batch, text)):
                    found = np.array([*encode(document), end_id], "<u4")
                    for at in range(0, len(found), length):
                        piece = found[at : at + length]
                        row.append(i)
                        start.append(at)
                        size.append(len(piece))
                        total.append(len(found))
                        narrow = piece.max() < 1 << 16
                        ids.append((piece.astype("<u2") if narrow else piece).tobytes())
                columns = [
                    *batch.select(keep).take(pa.array(row, pa.int64())).columns,
                    *(pa.array(values, pa.int64()) for values in (start, size, total)),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    keep = [c for c in docs.columns if c != text]
    names = [*keep, "start", "length", "doc_tokens", "ids"]
    schema = common.added(docs.drop(text), "start long, length long, doc_tokens long, ids binary")
    return docs.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = SEQUENCE,
    end_id: int = END_ID,
    seed: int = 17,
    group_bytes: int = GROUP_BYTES,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece with its place: ``sequence_id``, ``offset`` and the ``ids`` there.

    ``ids`` holds little-endian unsigned 32-bit numbers. A partition of the shuffle holds
    the pieces of a group, which grow in number with the input, not in size.
    """
    keys = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    bytes_ = keys.agg(F.sum(F.octet_length("text") + F.lit(8))).first()[0] or 0
    groups = max(1, math.ceil(bytes_ / group_bytes))
    pieces = tokenise(keys, "text", end_id, length, vocabulary)
    # The ids themselves spread documents that repeat a document id or have none.
    dealt = pieces.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "start", "ids"))
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = list(batches)
        if not held or not sum(b.num_rows for b in held):
            return
        group = pa.Table.from_batches(held)
        order = pa.compute.sort_indices(
            group,
            sort_keys=[("length", "descending"), ("draw", "ascending"), ("doc_id", "ascending"),
                       ("start", "ascending"), ("ids", "ascending")],
        )
        sizes = group.column("length").take(order).to_numpy()
        bins, offsets = first_fit_decreasing(sizes, length)
        first = TaskContext.get().partitionId() * GROUP_STRIDE
        for at in range(0, len(order), 512):
            part = group.take(order[at : at + 512])
            ids = [
                b if len(b) == 4 * n else np.frombuffer(b, "<u2").astype("<u4").tobytes()
                for b, n in zip(part.column("ids").to_pylist(), part.column("length").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).combine_chunks() for c in names[:4]),
                    pa.array(first + bins[at : at + 512]),
                    pa.array(offsets[at : at + 512]),
                    pa.array(ids, pa.binary()),
                ],
                names=names,
            )

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.repartition(groups, "draw").mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
