"""Filling in missing cities and countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions import text
from stayledger.operators.columns import beside
from stayledger.operators.joins import lookup_join, unique_lookup
from stayledger.storage import stage_table

PLACE_KEY = ["hotel_name", "city", "country"]


def _group_value(column: str) -> Column:
    """Smallest text of a group, any other text before the blank one."""
    col = F.col(column)
    return F.coalesce(F.min(F.nullif(col, F.lit(""))), F.min(col))


def group_values(
    df: DataFrame,
    targets: Sequence[str],
    group: str,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Per group the value each target column is filled with, under ``_fill_`` names.

    The distinct combinations come first: they are found by hashing, while a smallest text
    needs sorting, which is then over few rows. They are counted, and the counts used, since
    the optimizer would merge a plain distinct into the aggregate above it.
    """
    columns = list(dict.fromkeys([group, *targets]))
    df = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    members = df.filter(~F.coalesce(F.col(group).isin(list(exclude)), F.lit(False))) if exclude else df
    fills = members.groupBy(F.col(group).alias("_group")).agg(
        *[_group_value(t).alias(f"_fill_{t}") for t in targets], F.sum("_n").alias("_rows")
    )
    useful = F.coalesce(*[F.col(f"_fill_{t}") for t in targets]).isNotNull()
    return fills.filter(useful & (F.col("_rows") > 0)).drop("_rows")


def _apply_fill(joined: DataFrame, targets: Sequence[str], blank_as_null: bool) -> DataFrame:
    def known(t: str) -> Column:
        return F.nullif(F.col(t), F.lit("")) if blank_as_null else F.col(t)

    return joined.withColumns(
        {t: F.coalesce(known(t), F.col(f"_fill_{t}"), F.col(t)) for t in targets}
    ).drop(*[f"_fill_{t}" for t in targets])


def fill_within_group(
    df: DataFrame,
    targets: Sequence[str],
    group: str,
    exclude: Sequence[str] = (),
    blank_as_null: bool = False,
) -> DataFrame:
    """Fill missing targets from other rows of the same group (a missing group is one too).

    The values are a small table in the shared folder, so their size is known and the wide
    rows do not move for one that Spark broadcasts.
    """
    fills = stage_table(group_values(df, targets, group, exclude), "fills")
    return lookup_join(df, fills, [(group, "_group")], null_safe=True).transform(
        _apply_fill, targets, blank_as_null
    )


def normalized_lookup(df: DataFrame, *columns: str) -> DataFrame:
    """Lookup columns trimmed and in upper case."""
    return df.withColumns({c: F.upper(F.trim(F.col(c))) for c in columns})


def fill_from_lookup(
    df: DataFrame,
    target: str,
    key: str,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    match: str = "exact",
) -> DataFrame:
    """Where the target is missing or ``UNKNOWN``, take the lookup's value for the key.

    ``match="normalized"`` compares the trimmed upper-case key instead of the text as is.
    """
    if match not in ("exact", "normalized"):
        raise ValueError(f"unknown match: {match}")
    single = unique_lookup(lookup, lookup_key, lookup_value, "_ref_key", "_ref_value")
    probe = "_probe" if match == "normalized" else key
    if match == "normalized":
        df = df.withColumn(probe, F.upper(F.trim(F.col(key))))
    joined = lookup_join(df, single, [(probe, "_ref_key")])
    filled = F.when(text.needs_place(F.col(target)), F.col("_ref_value")).otherwise(F.col(target))
    return joined.withColumn(target, filled).drop("_ref_value", *(["_probe"] if match == "normalized" else []))


def place_keys(df: DataFrame) -> DataFrame:
    """The distinct (hotel name, city, country) of bookings, under ``_seen_`` names.

    Sets of them merge by union, so they can be kept up to date piece by piece.
    """
    return df.select(*[F.col(c).alias(f"_seen_{c}") for c in PLACE_KEY]).distinct()


def places_of(
    seen: DataFrame, city_country: DataFrame, country_capital: DataFrame, match: str = "exact"
) -> DataFrame:
    """Final city and country of each of the ``place_keys`` of all bookings there are."""
    places = seen.withColumns({c: F.col(f"_seen_{c}") for c in PLACE_KEY})

    def fill(frame: DataFrame, targets: Sequence[str], group: str) -> DataFrame:
        # Plain joins here: adaptive execution picks the strategy from measured sizes.
        fills = group_values(frame, targets, group)
        joined = frame.join(fills, frame[group].eqNullSafe(fills["_group"]), "left")
        return _apply_fill(joined.drop("_group"), targets, False)

    places = fill(places, ["city", "country"], "hotel_name")
    places = fill(places, ["country"], "city")
    places = fill_from_lookup(places, "country", "city", city_country, "city", "country", match)
    places = fill_from_lookup(places, "city", "country", country_capital, "country", "capital", match)
    return places.select(
        *[F.col(f"_seen_{c}") for c in PLACE_KEY],
        text.geo_label(F.col("city")).alias("_city"),
        text.geo_label(F.col("country")).alias("_country"),
    )


def place_map(
    df: DataFrame, city_country: DataFrame, country_capital: DataFrame, match: str = "exact"
) -> DataFrame:
    """Final city and country of each (hotel name, city, country) that occurs.

    The place of a booking depends on these three columns alone. So one pass reduces the
    bookings to their distinct combinations, and all fill steps run on that small table.
    """
    return places_of(stage_table(place_keys(df), "places-seen"), city_country, country_capital, match)


def join_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """Bookings with the city and country that a stored place map has for them."""

    def placed(few: DataFrame) -> DataFrame:
        joined = lookup_join(few, places, [(c, f"_seen_{c}") for c in PLACE_KEY], null_safe=True)
        return joined.withColumns({"city": F.col("_city"), "country": F.col("_country")}).drop("_city", "_country")

    return beside(df, PLACE_KEY, placed)


def fill_customer_places(
    df: DataFrame, city_country: DataFrame, country_capital: DataFrame, match: str = "exact"
) -> DataFrame:
    """Fill and finalise city and country of the customer, from lookups alone."""
    if not {"city_customer", "country_customer"} <= set(df.columns):
        return df
    places = ["city_customer", "country_customer"]

    def filled(few: DataFrame) -> DataFrame:
        few = fill_from_lookup(few, "country_customer", "city_customer", city_country, "city", "country", match)
        few = fill_from_lookup(few, "city_customer", "country_customer", country_capital, "country", "capital", match)
        return few.withColumns({c: text.geo_label(F.col(c)) for c in places})

    return beside(df, places, filled)


def fill_places(
    df: DataFrame,
    city_country: DataFrame,
    country_capital: DataFrame,
    match: str = "exact",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Fill and finalise city and country of hotel and customer.

    ``seen`` is a frame with the same places, by default the bookings themselves.
    """
    places = None
    if set(PLACE_KEY) <= set(df.columns):
        places = stage_table(place_map(df if seen is None else seen, city_country, country_capital, match), "places")
    return fill_from_places(df, places, city_country, country_capital, match)


def fill_from_places(
    df: DataFrame, places: DataFrame | None, city_country: DataFrame, country_capital: DataFrame, match: str = "exact"
) -> DataFrame:
    """As ``fill_places``, from a stored place map, or of the customer only."""

    def filled(few: DataFrame) -> DataFrame:
        few = few if places is None else join_places(few, places)
        return fill_customer_places(few, city_country, country_capital, match)

    return beside(df, [*PLACE_KEY, "city_customer", "country_customer"], filled)
