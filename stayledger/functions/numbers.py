"""Numbers: lenient casts, guards, ratings, money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayledger.constants import (
    BASE_CURRENCY,
    BUDGET_BELOW,
    MID_RANGE_BELOW,
    RAIN_THRESHOLD,
    RATING_MAX,
    RATING_MIN,
    RATING_WORDS,
)

# Plain decimal notation; anything else (exponents, suffixes, words) is no whole number.
_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def to_int(col: Column) -> Column:
    """Whole part of a plain number in text, NULL for anything else."""
    return F.when(col.rlike(_PLAIN_NUMBER), col.try_cast("double").try_cast("int"))


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def null_outside(
    col: Column, low=None, high=None, low_open: bool = False, high_open: bool = False
) -> Column:
    """NULL for values below ``low`` or above ``high``; open ends exclude the limit itself."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((col <= low) if low_open else (col < low))
    if high is not None:
        bad = bad | ((col >= high) if high_open else (col > high))
    return F.when(bad, F.lit(None)).otherwise(col)


def rating_digits(col: Column) -> Column:
    """Rating text with words replaced by digits."""
    text = F.lower(F.trim(col))
    for word, digit in RATING_WORDS.items():
        text = F.replace(text, F.lit(word), F.lit(digit))
    return text


def rating_in_range(col: Column, highest: int = RATING_MAX) -> Column:
    return null_outside(col, RATING_MIN, highest)


def normalize_rating(col: Column, highest: int = RATING_MAX) -> Column:
    """Rating text, in digits or words, as a whole number from 1 to ``highest``."""
    return rating_in_range(to_int(rating_digits(col)), highest)


def price_category(usd: Column) -> Column:
    """Price band; a missing price falls through to the top band."""
    return (
        F.when(usd < BUDGET_BELOW, "Budget")
        .when(usd < MID_RANGE_BELOW, "Mid-Range")
        .otherwise("Luxury")
    )


def is_rainy(rain: Column) -> Column:
    return F.coalesce(rain > RAIN_THRESHOLD, F.lit(False))


def effective_rate(code: Column, day_rate: Column, mean_rate: Column) -> Column:
    """1 for the base currency, else the day's rate, the mean rate, or 1."""
    return F.when(code == BASE_CURRENCY, F.lit(1.0)).otherwise(
        F.coalesce(day_rate, mean_rate, F.lit(1.0))
    )


def convert(amount: Column, rate: Column, rate_quote: str = "multiply") -> Column:
    """Amount at a rate; ``per_usd`` divides, for rates quoted as units per dollar."""
    if rate_quote == "per_usd":
        return F.try_divide(amount, rate)
    if rate_quote == "multiply":
        return amount * rate
    raise ValueError(f"unknown rate quote: {rate_quote}")
