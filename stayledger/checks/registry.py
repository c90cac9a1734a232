"""Registry of queries: a Spark function per key, and its SQL where one can be given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayledger.checks.oracle import chain

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, key: str | None = None, **steps: str) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` may refer to the named oracle steps.

    ``steps`` replaces the text of some of these steps.
    """

    def register(fn: Query) -> Query:
        name = key or fn.__name__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = chain(sql, **steps)
        return fn

    return register
