"""Projections, filters and imputation over groups of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.constants import LAST_VALID_YEAR, UNKNOWN_LABEL
from stayledger.functions import dates, numbers, text


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of the columns that the frame has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def map_columns(
    df: DataFrame, columns: Iterable[str], fn: Callable[[Column], Column]
) -> DataFrame:
    """Apply one expression to many columns in a single projection."""
    targets = present(df, columns)
    return df.withColumns({c: fn(F.col(c)) for c in targets}) if targets else df


# So many columns fit into one method that the JVM compiles.
FEW = 4


def apart(column: Column, fn: Callable[[Column], Column] = lambda c: c) -> Column:
    """An expression on a column, as a lambda.

    Whole-stage code puts a projection of many columns into one generated method of more than
    the 8000 bytes that the JVM compiles, and all of it is interpreted. Spark leaves a
    projection with a lambda out of whole-stage code and cuts up its code into small methods.
    The lambda itself is interpreted, so one column of a projection is enough.
    """
    return F.transform(F.array(column), fn)[0]


def mapped(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column]) -> dict[str, Column]:
    """One expression on each of the text columns; in a wide frame the first is ``apart``."""
    texts = {c: F.col(c).cast("string") for c in columns}
    first = columns[0] if columns and len(df.columns) > FEW else None
    return {c: apart(t, fn) if c == first else fn(t) for c, t in texts.items()}


def map_texts(
    df: DataFrame, columns: Iterable[str], fn: Callable[[Column], Column]
) -> DataFrame:
    """Apply one long expression to many text columns, in a projection of compiled code."""
    targets = present(df, columns)
    return df.withColumns(mapped(df, targets, fn)) if targets else df


PACKED = "_packed"


def beside(df: DataFrame, columns: Iterable[str], steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Take steps that look at few columns of a wide frame, with all others packed into one.

    Each join and projection on the way copies the packed columns at once, not one by one.
    Steps may replace the given columns and add new ones.
    """
    few = set(columns)
    rest = [c for c in df.columns if c not in few]
    if len(rest) <= FEW:
        return steps(df)
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]).alias(PACKED)
    done = steps(df.select(*[F.col(f"`{c}`") for c in df.columns if c in few], packed))
    new = [c for c in done.columns if c not in few and c != PACKED]
    own = [F.col(f"`{c}`") if c in few else F.col(PACKED).getField(c).alias(c) for c in df.columns]
    added = [F.col(f"`{c}`") for c in new]
    if added:
        added[0] = apart(added[0]).alias(new[0])
    return done.select(*own, *added)


def strip_edges(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return map_texts(df, columns, text.strip_edges)


def require_key(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose key is present, not blank and not the word ``null``."""
    return df.filter(text.has_key(F.col(column)))


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def fill_unknown(df: DataFrame, columns: Iterable[str], label: str = UNKNOWN_LABEL) -> DataFrame:
    return map_texts(df, columns, lambda c: text.label_blank(c, label))


def finalize_geo(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return map_columns(df, columns, text.geo_label)


def parse_dates(df: DataFrame, columns: Iterable[str], formats=None) -> DataFrame:
    if formats is None:
        return map_texts(df, columns, lambda c: dates.parse_date(c))
    return map_texts(df, columns, lambda c: dates.parse_date(c, formats))


def fill_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


def null_after_year(
    df: DataFrame, columns: Iterable[str], last_year: int = LAST_VALID_YEAR
) -> DataFrame:
    return map_columns(df, columns, lambda c: dates.null_after_year(c, last_year))


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace missing values by a constant per column."""
    usable = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(usable) if usable else df


def non_negative_money(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text to double; garbage and negative amounts become NULL."""
    return map_columns(df, columns, lambda c: numbers.null_outside(numbers.to_double(c), low=0))


def upper_ids(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return map_columns(df, columns, F.upper)
