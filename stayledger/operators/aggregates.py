"""Profiles and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max per column, in one pass over the rows."""
    stats = {"n": F.count, "mean": F.mean, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    one_row = df.agg(
        *[fn(F.col(c).cast("double")).alias(f"{c}__{s}") for c in columns for s, fn in stats.items()]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"{c}__{s}").alias("count" if s == "n" else s) for s in stats],
            )
            for c in columns
        ]
    )
    return one_row.select(F.inline(entries))


def top_k(df: DataFrame, column: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest values; ties are settled by further columns."""
    return df.orderBy(F.desc_nulls_last(column), *[F.asc_nulls_first(c) for c in tie_break]).limit(k)
