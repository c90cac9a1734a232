"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayledger.constants import (
    EDGE_CHARACTERS,
    EDGE_PATTERN,
    NON_LETTERS_PATTERN,
    NULL_WORD,
    UNKNOWN_GEO,
    UNKNOWN_LABEL,
)

_LINE_ENDS = ["\n", "\r", "\u0085", "\u2028", "\u2029"]


def strip_edges(col: Column) -> Column:
    """Drop runs of junk characters at both ends, then the blanks around what is left.

    A two-sided trim does it at half the cost of the regular expression. Only text that
    ends in a line break takes the latter, whose ``$`` also looks before that break.
    """
    ends_in_break = F.right(col, F.lit(1)).isin(_LINE_ENDS)
    stripped = F.when(ends_in_break, F.regexp_replace(col, EDGE_PATTERN, "")).otherwise(
        F.btrim(col, F.lit(EDGE_CHARACTERS))
    )
    return F.trim(stripped)


def letters_key(col: Column) -> Column:
    """Upper-case key of the ASCII letters and white space of a name."""
    return F.upper(F.trim(F.regexp_replace(col, NON_LETTERS_PATTERN, "")))


def is_blank(col: Column) -> Column:
    return col.isNull() | (col == "")


def label_blank(col: Column, label: str = UNKNOWN_LABEL) -> Column:
    return F.when(is_blank(col), F.lit(label)).otherwise(col)


def geo_label(col: Column) -> Column:
    """Final form of a place name: upper case, ``UNKNOWN`` when missing."""
    return F.when(is_blank(col), F.lit(UNKNOWN_GEO)).otherwise(F.upper(col))


def has_key(col: Column) -> Column:
    """True for a usable key: present, not blank, not the word ``null``.

    The column is named once, since a filter is pushed down with a copy of the cleaning
    behind each mention of it.
    """
    return ~F.coalesce(col, F.lit("")).isin("", NULL_WORD)


def needs_place(col: Column) -> Column:
    return col.isNull() | (col == UNKNOWN_GEO)


def differs_keep_null(col: Column, value) -> Column:
    """``col <> value`` that also keeps rows where the column is missing."""
    return ~col.eqNullSafe(F.lit(value))


def is_member(col: Column, values: list) -> Column:
    """Membership test in which None is an ordinary member."""
    present = [v for v in values if v is not None]
    test = col.isin(present) if present else F.lit(False)
    return F.coalesce(test, F.lit(False)) | col.isNull() if None in values else test
