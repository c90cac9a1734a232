"""Shared inputs of the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayledger.operators import columns as ops
from stayledger.operators.geo import PLACE_KEY
from stayledger.constants import EDGE_CLEANED_COLUMNS
from stayledger.plans.enrich import to_gold
from stayledger.plans.silver import Lookups, clean_bookings, clean_edges_and_keys
from stayledger.plans.star import HOTEL_ORDER, Star, build_star, store_star
from stayledger.schemas import DIM_CUSTOMERS, DIM_HOTELS, FCT_BOOKINGS
from stayledger.sources import bookings as B
from stayledger.storage import stage_table, workspace

raw = B.raw_bookings


def edged(spark: SparkSession, sf: str, *columns: str, keep: Sequence[str] = ()) -> DataFrame:
    """Raw bookings with clean edges."""
    return ops.strip_edges(raw(spark, sf, columns, keep), EDGE_CLEANED_COLUMNS)


def keyed(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Bookings after edge cleaning, key filter and ``Unknown`` labels."""
    wanted = list(dict.fromkeys([*columns, "hotel_id"]))
    return clean_edges_and_keys(raw(spark, sf, wanted)).select(*columns)


def lookups(spark: SparkSession, sf: str) -> Lookups:
    return Lookups(B.city_country(spark, sf), B.country_capital(spark, sf))


def silver(spark: SparkSession, sf: str, *columns: str, every_table: bool = False) -> DataFrame:
    """Silver bookings; with columns given, only what these need is read and, unless told so, joined."""
    wanted = None
    if columns:
        extra = ["hotel_id"]
        if {"city", "country"} & set(columns):
            extra += ["hotel_name", "city", "country"]
        if {"city_customer", "country_customer"} & set(columns):
            extra += ["city_customer", "country_customer"]
        if "booking_date" in columns:
            extra += ["checkin_date"]
        wanted = list(dict.fromkeys([*columns, *extra]))
    bookings = raw(spark, sf, wanted, every_table=every_table)
    hotels = raw(spark, sf, [*PLACE_KEY, "hotel_id"])
    df = clean_bookings(bookings, lookups(spark, sf), B.LAST_YEAR, hotels=hotels)
    return df.select(*columns) if columns else df


def gold(spark: SparkSession, sf: str, *columns: str, every_table: bool = False) -> DataFrame:
    """Gold bookings computed from the raw tables."""
    return to_gold(silver(spark, sf, *columns, every_table=every_table), *reference(spark, sf))


def reference(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Rates and weather as stored tables, so that their sizes are known."""
    return stage_table(B.daily_rates(spark, sf), "rates"), stage_table(B.daily_weather(spark, sf), "weather")


_SOURCES = ("lineitem", "orders", "customer", "supplier", "nation")
# Stored gold tables of a session and its source files: where, and the columns.
_STORED: dict[tuple, list[tuple[str, StructType]]] = {}
# Silver columns that rates, weather and the key test look at; every gold table has them.
_GOLD_KEYS = ("booking_id", "hotel_id", "booking_date", "checkin_date", "city", "country", "total_price")


def _fingerprint(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the files behind the gold table."""
    files = spark.read.format("binaryFile").load([f"{sf}/{name}.parquet" for name in _SOURCES])
    return tuple(sorted(tuple(r) for r in files.select("path", "length", "modificationTime").collect()))


def gold_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """A stored gold table of this session, written on first use of these source files.

    Models and dashboards read stored layers; so the long way from raw bookings is gone
    once per session, not once per chart. With columns given, a table that has these is
    enough: it is cleaned, enriched and stored without the dozens of others. The bookings
    are the same in all of them. Changed files make it anew.
    """
    stored = _STORED.setdefault((spark.sparkContext.applicationId, _fingerprint(spark, sf)), [])
    for path, schema in list(stored):
        if set(columns or B.BOOKING_COLUMNS) <= set(schema.names):
            try:
                return spark.read.schema(schema).parquet(path)
            except AnalysisException:
                stored.remove((path, schema))
    cleaned = dict.fromkeys([*_GOLD_KEYS, *columns]) if columns else {}
    df = gold(spark, sf, *[c for c in cleaned if c in B.BOOKING_COLUMNS], every_table=True)
    path = workspace(spark, "gold")
    df.write.parquet(path)
    stored.append((path, df.schema))
    return spark.read.schema(df.schema).parquet(path)


# Columns of gold that each dimension is made of; all of them say which row of a key counts.
DIMENSION_COLUMNS = {
    "hotels": (*DIM_HOTELS.names, *HOTEL_ORDER, "booking_date"),
    "dates": ("booking_date",),
    "customers": tuple(DIM_CUSTOMERS.names),
}


def star(spark: SparkSession, sf: str, fact: Sequence[str] = FCT_BOOKINGS.names, *dimensions: str) -> Star:
    """The star of a stored gold table, with the named columns of the fact and the named dimensions."""
    columns = dict.fromkeys([*fact, *(c for d in dimensions for c in DIMENSION_COLUMNS[d])])
    return build_star(gold_table(spark, sf, *columns), fact, dimensions)


_STARS: dict[tuple, tuple[str, Star]] = {}
# A partition of a month has so many files; the given tables are small.
_STAR_BUCKETS = 4


def stored_star(spark: SparkSession, sf: str) -> Star:
    """The star as stored, partitioned and bucketed tables of this session, written on first use."""
    key = (spark.sparkContext.applicationId, _fingerprint(spark, sf))
    if key not in _STARS or not spark.catalog.tableExists(_STARS[key][0]):
        name = f"star_{uuid.uuid4().hex}"
        made = store_star(star(spark, sf, FCT_BOOKINGS.names, *DIMENSION_COLUMNS), name, workspace(spark, "star"), _STAR_BUCKETS)
        _STARS[key] = (f"{name}_fct_bookings", made)
    return _STARS[key][1]


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


def before_after(df: DataFrame, fn, *columns: str, ids: Sequence[str] = ("booking_id",)) -> DataFrame:
    """Row ids beside each column before and after an expression."""
    pairs: list[Column] = []
    for c in columns:
        pairs += [F.col(c).alias(f"{c}_before"), fn(F.col(c)).alias(f"{c}_after")]
    return df.select(*ids, *pairs)
