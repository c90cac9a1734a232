"""Centroid clustering of vectors, with lower bounds from Ptolemy's inequality.

Vectors are whole numbers, so distances, sums and centroids are exact. Fixed pivots are
chosen among the starting centroids, far from each other. A vector keeps its distances to
the pivots; for a pair of pivots p, q and a centroid c, Ptolemy's inequality says
d(v,c) * d(p,q) >= |d(v,p) d(c,q) - d(v,q) d(c,p)|, and the triangle inequality is the case
of one pivot, so a few multiplications bound every centroid's distance from below. The
centroid with the least bound is measured first; another is measured only if its bound,
lowered by more than rounding can have raised it, is not above what is known. Equal
distances go to the smaller number.

One pass stores whole vectors with their distances to the pivots. Each round reads them once
and sums members in the tasks, so that one row for each task and centroid is shuffled,
however large a cluster is. The driver sees the starting vectors and one sum for each centroid.

Defined results: vectors of another length, or with a missing or non-finite component, are
left out; repeated rows count each; start vectors with equal hashes are taken in the order of
their components, rows without an id start no centroid unless others are too few; with fewer
rows than centroids each row starts one; an empty table has no result. A component of 2^26 or
more after scaling cannot have its squared distances in 64 bits and is an error. Columns go
through, but for the vector and those named like a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm import common
from stayledger.storage import stage_table

CENTROIDS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
PIVOTS = 6
# Beyond this the sum of squares of differences could pass 64 bits.
LARGEST = 1 << 26
# Bounds are sums and quotients of a few numbers; their relative error is far below this.
SAFETY = 1e-9


def whole_vectors(vectors: DataFrame, vector: str, dimensions: int, scale: int) -> Column:
    """Components as whole numbers; null unless all are there and finite."""
    x = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    low, high = F.lit(-LARGEST / scale), F.lit(LARGEST / scale)
    number = lambda v: F.when((v > low) & (v < high), F.floor(v * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("int")
    )
    return F.when((F.size(x) == dimensions) & ~bad, F.transform(x, number))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two arrays."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def choose_pivots(start: np.ndarray, pivots: int) -> np.ndarray:
    """Different vectors among the starting ones, each as far as can be from those before."""
    chosen = [0]
    near = squared(start, start[:1])
    while len(chosen) < pivots and near.max(initial=0) > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(start, start[chosen[-1:]]))
    return start[chosen]


class Bounds:
    """Lower bounds of distances to centroids from distances to pivots."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.centroids = centroids
        self.near = np.stack([np.sqrt(squared(centroids, p[None])) for p in pivots], 1)
        pairs = [(i, j) for i in range(len(pivots)) for j in range(i)]
        self.pairs = [(i, j, float(np.sqrt(squared(pivots[i : i + 1], pivots[j : j + 1])[0]))) for i, j in pairs]

    def below(self, cached: np.ndarray) -> np.ndarray:
        """Of each vector and centroid a number that their distance is not below."""
        out = np.zeros((len(cached), len(self.centroids)))
        for i in range(cached.shape[1]):
            np.maximum(out, np.abs(cached[:, i, None] - self.near[None, :, i]), out=out)
        for i, j, apart in self.pairs:
            # Largest products of the pair say how far rounding can reach.
            a, b = cached[:, i, None] * self.near[None, :, j], cached[:, j, None] * self.near[None, :, i]
            np.maximum(out, (np.abs(a - b) - SAFETY * (a + b)) / apart, out=out)
        reach = cached.max(1)[:, None] + self.near.max(1)[None, :]
        return np.maximum(out - SAFETY * reach, 0)

    def nearest(self, vectors: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and exact squared distance of the nearest centroid, and how many were measured."""
        # Bounds are squared downwards, to compare them with exact squares.
        below = self.below(cached) ** 2 * (1 - SAFETY)
        first = below.argmin(1)
        best = squared(vectors, self.centroids[first])
        number, measured = first.astype(np.int64), len(vectors)
        for c in range(len(self.centroids)):
            open_ = np.flatnonzero((below[:, c] <= best) & (first != c))
            if len(open_):
                measured += len(open_)
                found = squared(vectors[open_], self.centroids[c][None])
                nearer = (found < best[open_]) | (found == best[open_]) & (c < number[open_])
                best[open_[nearer]], number[open_[nearer]] = found[nearer], c
        return number, best, measured


def start_vectors(kept: DataFrame, key: str, centroids: int, seed: int, dimensions: int) -> np.ndarray:
    """The kept vectors with the smallest hashes of seed and id: as many as there are centroids."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")).cast("binary"), 256)
    chosen = kept.select(hashed.alias("hash"), "_ints").orderBy(F.col("hash").asc_nulls_last(), "_ints").limit(centroids)
    return np.array([r["_ints"] for r in chosen.collect()], np.int64).reshape(-1, dimensions)


def with_pivots(kept: DataFrame, pivots: np.ndarray, dimensions: int) -> DataFrame:
    """Vectors with their distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("_ints"), dimensions)
            near = np.stack([np.sqrt(squared(x, p[None])) for p in pivots], 1)
            cached = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield common.append(batch, [cached], ["_near"])

    return kept.mapInArrow(run, common.added(kept, "_near array<double>"))


def sums(stored: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each centroid with members their number and sums of components."""
    dimensions = centroids.shape[1]
    names = [f"s{i}" for i in range(dimensions)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(pivots, centroids)
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dimensions), np.int64)
        for batch in batches:
            x = matrix(batch.column("_ints"), dimensions)
            number = bounds.nearest(x, matrix_of_floats(batch.column("_near"), len(pivots)))[0]
            count += np.bincount(number, minlength=len(centroids))
            np.add.at(total, number, x)
        some = np.flatnonzero(count)
        columns = [pa.array(some), pa.array(count[some]), *(pa.array(total[some, i]) for i in range(dimensions))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", *names])

    schema = ", ".join(f"{c} long" for c in ["cluster", "n", *names])
    parts = stored.select("_ints", "_near").mapInArrow(run, schema)
    found = parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ["n", *names]]).collect()
    return {r["cluster"]: (r["n"], [r[c] for c in names]) for r in found}


def matrix_of_floats(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


RESULTS = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Every whole vector with its cluster, distance, inertias and its centroid's checksum."""
    names = T.StructType.fromDDL(RESULTS).names
    keep = common.carried(vectors, [vector, *names])
    own = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    kept = vectors.select(own, F.col(f"`{key}`").alias("_key"), whole_vectors(vectors, vector, dimensions, scale).alias("_ints"))
    kept = kept.where("_ints is not null")
    now = start_vectors(kept, "_key", centroids, seed, dimensions)
    schema = T.StructType([*vectors.select(*[f"`{c}`" for c in keep]).schema.fields, *T.StructType.fromDDL(RESULTS).fields])
    if not len(now):
        return vectors.sparkSession.createDataFrame([], schema)
    fixed = choose_pivots(now, pivots)
    stored = stage_table(with_pivots(kept.drop("_key"), fixed, dimensions), "vectors-near")
    for _ in range(rounds):
        for number, (n, total) in sums(stored, fixed, now).items():
            now[number] = [s // n for s in total]
    assigned = stage_table(assign(stored, fixed, now), "vectors-assigned")
    # As many rows as there are centroids.
    inertia = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    facts = [(c, inertia.get(c, 0), marks[c]) for c in range(len(now))]
    facts = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(facts), "cluster").withColumn("inertia", F.lit(sum(inertia.values())).cast("long"))
    return joined.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], *names)


def assign(stored: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Rows with ``cluster`` and ``distance``."""
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(pivots, centroids)
        for batch in batches:
            x = matrix(batch.column("_ints"), dimensions)
            number, best, _ = bounds.nearest(x, matrix_of_floats(batch.column("_near"), len(pivots)))
            new = [pa.array(number.astype(np.int32)), pa.array(best)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *new], names=["_row", "cluster", "distance"])

    return stored.mapInArrow(run, common.added(stored.select("_row"), "cluster int, distance long"))
