"""Raw bookings to clean, typed bookings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger import constants as C
from stayledger.functions import dates, numbers, text
from stayledger.operators import columns as ops
from stayledger.operators.geo import PLACE_KEY, fill_places
from stayledger.operators.sets import union_sources


@dataclass(frozen=True)
class Lookups:
    """City to country and country to capital."""

    city_country: DataFrame
    country_capital: DataFrame


def clean_edges_and_keys(df: DataFrame) -> DataFrame:
    """Row-wise text steps before places are filled; fit for batch and stream alike.

    A step that names its column more than once stands in a projection of its own: composed
    into one expression, the steps before it would be computed for each mention. The key is
    cleaned apart from the others, as its filter is pushed down with a copy of its cleaning.
    """
    if "hotel_id" in df.columns:
        df = ops.require_key(df.withColumn("hotel_id", text.strip_edges(F.col("hotel_id"))), "hotel_id")
    df = ops.strip_edges(df, [c for c in C.EDGE_CLEANED_COLUMNS if c != "hotel_id"])
    return ops.fill_unknown(df, C.UNKNOWN_LABEL_COLUMNS)


def type_columns(df: DataFrame, last_year: int = C.LAST_VALID_YEAR) -> DataFrame:
    """Row-wise typing steps after places are filled; fit for batch and stream alike.

    As above, steps whose result is named more than once have projections of their own.
    """
    days, ratings = ops.present(df, C.DATE_COLUMNS), ops.present(df, C.RATING_COLUMNS)
    money, ids = ops.present(df, C.MONEY_COLUMNS), ops.present(df, C.UPPER_ID_COLUMNS)
    read = ops.mapped(df, days, lambda c: dates.parse_date(c))
    read |= {c: numbers.rating_digits(F.col(c).cast("string")) for c in ratings}
    read |= {c: numbers.to_int(F.col(c)) for c in ops.present(df, ["total_rooms"])}
    read |= {c: numbers.to_double(F.col(c)) for c in money}
    read |= {c: F.upper(F.col(c)) for c in ids}
    held = {c: dates.null_after_year(F.col(c), last_year) for c in ops.present(df, C.YEAR_GUARDED_COLUMNS)}
    if {"booking_date", "checkin_date"} <= set(days):
        booked = F.coalesce("booking_date", "checkin_date")
        held["booking_date"] = dates.null_after_year(booked, last_year) if "booking_date" in held else booked
    held |= {c: numbers.rating_in_range(numbers.to_int(F.col(c))) for c in ratings}
    held |= {c: rooms_in_range(F.col(c)) for c in ops.present(df, ["total_rooms"])}
    for c in money:
        amount = numbers.null_outside(F.col(c), low=0)
        held[c] = F.coalesce(amount, F.lit(0.0)) if c in C.ZERO_FILLED_COLUMNS else amount
    # Both projections stay out of whole-stage code where the frame is wide.
    if "booking_date" in held and len(df.columns) > ops.FEW:
        held["booking_date"] = ops.apart(held["booking_date"])
    for step in (read, held):
        df = df.withColumns(step) if step else df
    return df


def rooms_in_range(col: Column) -> Column:
    return numbers.null_outside(col, C.ROOMS_TOO_FEW, C.ROOMS_TOO_MANY, low_open=True, high_open=True)


def rooms(col: Column) -> Column:
    return rooms_in_range(numbers.to_int(col))


def clean_stateless(df: DataFrame, last_year: int = C.LAST_VALID_YEAR) -> DataFrame:
    """All silver steps that look at one row only."""
    return type_columns(clean_edges_and_keys(df), last_year)


def cleaned_places(raw: DataFrame) -> DataFrame:
    """Hotel names, cities and countries of the bookings with a key, cleaned, each text once.

    They are far fewer than the bookings, so they are cleaned when they have been found.
    """
    places = ops.present(raw, PLACE_KEY)
    if "hotel_id" in raw.columns:
        raw = ops.require_key(raw.withColumn("hotel_id", text.strip_edges(F.col("hotel_id"))), "hotel_id")
    return clean_edges_and_keys(raw.select(*places).distinct())


def clean_bookings(
    raw: DataFrame,
    lookups: Lookups,
    last_year: int = C.LAST_VALID_YEAR,
    match: str = "exact",
    hotels: DataFrame | None = None,
) -> DataFrame:
    """Silver bookings from one raw frame; steps skip columns the frame does not have.

    ``hotels`` may give the raw place columns and hotel ids of the same bookings, where these
    can be had without all that the raw frame joins.
    """
    df = clean_edges_and_keys(raw)
    seen = cleaned_places(raw if hotels is None else hotels)
    df = fill_places(df, lookups.city_country, lookups.country_capital, match, seen)
    return type_columns(df, last_year)


def to_silver(
    batch: DataFrame,
    stream: DataFrame,
    lookups: Lookups,
    last_year: int = C.LAST_VALID_YEAR,
    match: str = "exact",
) -> DataFrame:
    """Silver bookings from the batch and the stream table, on their shared columns."""
    return clean_bookings(union_sources(batch, stream), lookups, last_year, match)


def bookings_per_year(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.year("booking_date").alias("year"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("year").asc_nulls_first())
    )
