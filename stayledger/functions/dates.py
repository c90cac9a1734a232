"""Date parsing and calendar parts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayledger.constants import CLEANING_DATE_FORMATS, LAST_VALID_YEAR


_FIELD_SHAPES = {"yyyy": r"\+?\d{4,}", "MM": r"(0[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])"}


def _shape(fmt: str) -> str:
    """Pattern that every text in a layout of year, month and day fields matches."""
    parts = [_FIELD_SHAPES.get(p, re.escape(p)) for p in re.split("(yyyy|MM|dd)", fmt)]
    return "^" + "".join(parts) + "$"


def _read(col: Column, fmt: str) -> Column:
    """Text of a layout's shape as a date.

    The date parser is slow. Text as long as its layout has a year of four digits, which a
    cast reads just as well; longer years take the parser.
    """
    parsed = F.try_to_date(col, fmt)
    if sorted(re.findall("yyyy|MM|dd", fmt)) != ["MM", "dd", "yyyy"]:
        return parsed
    year, month, day = (F.substring(col, fmt.index(p) + 1, len(p)) for p in ("yyyy", "MM", "dd"))
    iso = col if fmt == "yyyy-MM-dd" else F.concat(year, F.lit("-"), month, F.lit("-"), day)
    return F.when(F.length(col) == len(fmt), iso.try_cast("date")).otherwise(parsed)


def parse_date(col: Column, formats: Sequence[str] = CLEANING_DATE_FORMATS) -> Column:
    """First layout that reads the text as a calendar date; NULL when none does.

    Only text of the right shape is read, as refusing text is slow.
    """
    return F.coalesce(*[F.when(col.rlike(_shape(f)), _read(col, f)) for f in formats])


def parse_lenient(col: Column, formats: Sequence[str] = CLEANING_DATE_FORMATS) -> Column:
    """As ``parse_date``, also for one-digit days and months and with a time of day behind."""
    bare = F.regexp_replace(col, r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$", "")
    padded = F.regexp_replace(bare, r"(?<!\d)(\d)(?!\d)", "0$1")
    return parse_date(padded, formats)


def null_after_year(col: Column, last_year: int = LAST_VALID_YEAR) -> Column:
    return F.when(F.year(col) > last_year, F.lit(None)).otherwise(col)


def us_week(day: Column) -> Column:
    """Week of year counted from 1 January with weeks starting on Sunday."""
    first_weekday = F.dayofweek(F.trunc(day, "YEAR"))
    return (F.floor((F.dayofyear(day) + first_weekday - 2) / 7) + 1).cast("int")


def weekend_flag(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def year_month(day: Column) -> Column:
    return F.concat(
        F.year(day).cast("string"), F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0")
    )


def calendar_parts(day: Column) -> dict[str, Column]:
    """The calendar attributes of a day, by output name."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "week_of_year": us_week(day),
        "day_of_week_name": F.date_format(day, "EEEE"),
        "is_weekend": weekend_flag(day),
        "year_month": year_month(day),
    }
