"""What the operators share: reading tables, carrying columns, walking Arrow batches.

Functions that run in Spark's Python workers are pickled by value, so executors need the
installed libraries but not this package.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# No name of the package may stand in this module: modules that operators use go to the
# workers whole, and a package among their names would be looked for there.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# A worker looks at so many bytes of text at once, however Spark cuts its batches.
CHUNK_BYTES = 4 << 20


def sent_to_workers(spark: SparkSession, value) -> Callable[[], object]:
    """A value that workers get by one broadcast, whatever its class; the result gives it there."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    opened = []

    def get():
        if not opened:
            opened.append(pickle.loads(data.value))
        return opened[0]

    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int, doc_id: str = "doc_id"):
    """crc32 of an id's decimal text, modulo n: the split rule of training and held-out rows."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def carried(df: DataFrame, new: Iterable[str]) -> list[str]:
    """Columns that go through an operator: all but those its results replace by name."""
    taken = {name.lower() for name in new}
    return [c for c in df.columns if c.lower() not in taken]


def added(df: DataFrame, new: str) -> T.StructType:
    """Schema of a frame with columns added, given as a DDL string."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(new).fields])


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``limit`` bytes of text, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(
        zero_copy_only=False
    )
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a missing one is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of the texts of a batch; a missing one is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def append(batch: pa.RecordBatch, columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns], names=[*batch.schema.names, *names]
    )


def whole_rows(docs: DataFrame, *needed: str) -> DataFrame:
    """Needed columns and the whole row as one struct ``_row``, which no result can clash with."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *needed)


def labelled_sample(labels: DataFrame, label: str, rows: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``rows`` labelled ids of each of the labels 0 and 1, the first by a seeded hash.

    Also the number of all rows by label. Missing ids and other labels are left out.
    """
    marked = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(
        "y in (0, 1) and doc_id is not null"
    )
    counts = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    draw = F.xxhash64(F.lit(seed), "doc_id")
    parts = [marked.where(F.col("y") == y).orderBy(draw, "doc_id").limit(rows) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), counts
