"""Where intermediate results go: one shared folder, named by the session."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Below the shared folder, apart from what others keep there.
STAGED = "stayledger"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a fresh one only on a local master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="stayledger-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """Path of a new, not yet existing folder inside the shared folder."""
    return f"{shared_folder(spark)}/{STAGED}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as parquet into the shared folder and scan it from there."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The store behind a path, as Spark itself reaches it, and the path there."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    store, place = _file_system(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place) if s.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _file_system(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    store, place = _file_system(spark, path)
    store.delete(place, True)


def deal(spark: SparkSession, path: str, to: list[str]) -> None:
    """Move the visible files of a folder to others in turn."""
    store, place = _file_system(spark, path)
    names = sorted(s.getPath().getName() for s in store.listStatus(place) if s.isFile())
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in to:
        store.mkdirs(target(folder))
    for i, name in enumerate(n for n in names if not n.startswith(("_", "."))):
        if not store.rename(target(f"{path}/{name}"), target(f"{to[i % len(to)]}/{name}")):
            raise OSError(f"cannot move {name}")


def forget_staged(spark: SparkSession) -> int:
    """Remove all tables that operators staged in the shared folder, and say how many.

    For programs that have stored their results: frames that still scan staged tables end.
    """
    base = f"{shared_folder(spark)}/{STAGED}"
    found = folders(spark, base) if exists(spark, base) else []
    for name in found:
        remove(spark, f"{base}/{name}")
    return len(found)
