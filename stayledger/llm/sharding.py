"""Two-pass external shuffle into shards of equal row counts.

The first pass scatters whole records into buckets by a seeded hash; buckets are sized so
that one fits in a task's memory. The second pass brings each bucket into a random order
by a seeded Fisher-Yates shuffle. Buckets in order are then one random order of all
records; a record's rank in it gives its shard and its slot there, so that shards' row
counts are at most one apart (law ``rows``).

Defined results: a missing text has size 1 and the checksum of no bytes; equal rows each
take a slot of their own; a row without an id takes part like others. All columns go
through, but for those named like a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm import common

BUCKET_BYTES = 16 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of ``n`` records, the same for the same seed and bucket."""
    order = np.arange(n)
    draws = np.random.default_rng([seed, bucket]).random(n)
    for last in range(n - 1, 0, -1):
        other = int(draws[last] * (last + 1))
        order[last], order[other] = order[other], order[last]
    return order


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 8,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 29,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All records in random order with ``shard`` and ``slot``, both from their rank.

    The bucket of a record depends on its id and the seed. Three passes read the input: its size,
    the buckets' row counts, and the scatter itself, the only one to move records.
    """
    docs = docs.select(*[f"`{c}`" for c in common.carried(docs, ["shard", "slot"])])
    size, rows = docs.agg(F.sum(F.octet_length(text) + F.lit(64)), F.count(F.lit(1))).first()
    buckets = max(1, math.ceil((size or 0) / bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)).cast("int")
    counts = np.zeros(buckets, np.int64)
    # As many numbers as there are buckets.
    for b, n in docs.groupBy(bucket.alias("bucket")).count().collect():
        counts[b] = n
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = [math.ceil(s * rows / shards) for s in range(shards)]
    keep = docs.columns

    def shuffled(held: list[pa.RecordBatch], b: int) -> Iterator[pa.RecordBatch]:
        records = pa.Table.from_batches(held).select(keep)
        order = fisher_yates(records.num_rows, seed, b)
        rank = first[b] + np.arange(records.num_rows)
        shard = rank * shards // rows
        slot = rank - np.array(starts)[shard]
        for at in range(0, len(order), 1024):
            part = records.take(pa.array(order[at : at + 1024])).combine_chunks()
            new = [pa.array(shard[at : at + 1024], pa.int32()), pa.array(slot[at : at + 1024])]
            for batch in part.to_batches():
                yield common.append(batch, new, ["shard", "slot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            numbers = batch.column("_bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                if held and numbers[a] != now:
                    yield from shuffled(held, now)
                    held = []
                now = int(numbers[a])
                held.append(batch.slice(a, z - a))
        if held:
            yield from shuffled(held, now)

    scattered = (
        docs.withColumn("_bucket", bucket)
        .repartition(buckets, "_bucket")
        # An order that does not depend on how the records came; a bucket comes in one run.
        .sortWithinPartitions("_bucket", F.col(key), F.xxhash64(F.col(text)))
    )
    return scattered.mapInArrow(run, common.added(docs, "shard int, slot long"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of files per shard; rows of a file are in slot order."""
    sharded.write.partitionBy("shard").parquet(path)


def digest(sharded: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return sharded.select(
        "doc_id",
        (F.length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
