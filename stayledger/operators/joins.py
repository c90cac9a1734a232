"""Joins to lookups and time series, safe for hot keys and for lookups that grow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    null_safe: bool = False,
    shuffle: bool = False,
) -> DataFrame:
    """Left join on (frame column, lookup column) pairs; lookup key columns are dropped.

    The lookup's column names must not occur in the frame. Nothing is measured here: a lookup
    that is a stored table has its size in its statistics, and Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``, so the frame is not shuffled. A larger one is
    shuffled once, and adaptive execution splits the frame's hot keys. ``shuffle`` asks for
    that way whatever the size.
    """
    keys = [right for _, right in on]
    side = lookup.hint("merge") if shuffle else lookup
    tests = [df[a].eqNullSafe(side[b]) if null_safe else df[a] == side[b] for a, b in on]
    return df.join(side, reduce(lambda x, y: x & y, tests), "left").drop(*keys)


def unique_lookup(df: DataFrame, key: str, value: str, as_key: str, as_value: str) -> DataFrame:
    """One row per key, the smallest value winning, so that joins never fan out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(as_key))
        .agg(F.min(value).alias(as_value))
    )


def missing_keys(want: DataFrame, have: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``want`` whose key (want column -> have column) does not occur in ``have``."""
    present = have.select([F.col(h).alias(f"_have_{w}") for w, h in on.items()]).distinct()
    test = reduce(lambda x, y: x & y, [F.col(w) == F.col(f"_have_{w}") for w in on])
    return want.join(present, test, "left_anti")
