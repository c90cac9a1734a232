"""Star schema: one fact, three dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayledger.functions import dates
from stayledger.operators.columns import require_not_null
from stayledger.schemas import DIM_CUSTOMERS, DIM_DATE, DIM_HOTELS, FCT_BOOKINGS, conform


def fct_bookings(gold: DataFrame, columns: Sequence[str] = FCT_BOOKINGS.names) -> DataFrame:
    """Booking facts with an id, in the declared columns (or those named of them) and types."""
    contract = StructType([f for f in FCT_BOOKINGS.fields if f.name in columns])
    return require_not_null(gold, "booking_id").transform(conform, contract)


def dim_customers(gold: DataFrame) -> DataFrame:
    """Distinct customer rows; a customer seen with different details has several."""
    return require_not_null(gold, "customer_id").transform(conform, DIM_CUSTOMERS).distinct()


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, then by all its columns, missing first.

    An aggregate rather than a numbered window: rows are reduced before they are shuffled,
    so a key holding a large share of the rows is no hot task.
    """
    rest = [c for c in df.columns if c != key]
    ranked = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest]
    )
    best = df.groupBy(key).agg(F.min(ranked).alias("_first"))
    return best.select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def latest_first(day: Column) -> Column:
    """Ascending sort key that puts late days first and missing ones last."""
    return F.coalesce(-F.unix_date(day), F.lit(2**31 - 1))


HOTEL_ORDER = ["booking_id", "checkin_date", "nights", "total_price"]


def dim_hotels(gold: DataFrame) -> DataFrame:
    """One row per hotel, taken from its latest booking.

    The latest day per hotel is found by hashing; only the rows of that day, few for each
    hotel, are then compared by their other columns.
    """
    usable = require_not_null(gold, "hotel_id")
    day = latest_first(F.col("booking_date"))
    latest = usable.groupBy(F.col("hotel_id").alias("_hotel")).agg(F.min(day).alias("_day"))
    usable = usable.join(latest, (F.col("hotel_id") == F.col("_hotel")) & (day == F.col("_day"))).drop("_hotel", "_day")
    columns = [f.name for f in DIM_HOTELS.fields]
    order = [latest_first(F.col("booking_date")), *[F.col(c) for c in HOTEL_ORDER]]
    ranked = usable.select(*[o.alias(f"_r{i}") for i, o in enumerate(order)], *columns)
    picked = first_per_key(ranked, "hotel_id", [])
    return conform(picked, DIM_HOTELS)


def latest_per_key(df: DataFrame, key: str, day: str) -> DataFrame:
    """Optional clean-up for repeated keys: keep the row with the latest day."""
    return first_per_key(df, key, [latest_first(F.col(day))])


def date_spine(df: DataFrame, column: str, name: str = "date_key") -> DataFrame:
    """Every day from the first to the last one of a column."""
    bounds = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi")).alias(name))


def numbers(start: Column, stop: Column, name: str = "num") -> Column:
    """Counter from ``start`` to ``stop``, one row each."""
    return F.explode(F.sequence(start, stop)).alias(name)


def dim_date(gold: DataFrame) -> DataFrame:
    """One row per day between the first and the last booking."""
    days = date_spine(gold, "booking_date")
    return days.select("date_key", *[c.alias(n) for n, c in dates.calendar_parts(F.col("date_key")).items()]
                       ).transform(conform, DIM_DATE)


@dataclass(frozen=True)
class Star:
    """The fact, and its dimensions with one row per key."""

    fact: DataFrame
    hotels: DataFrame | None = None
    dates: DataFrame | None = None
    customers: DataFrame | None = None
    # Of a stored fact: its partition column -> (dimension, column there) with the same values.
    partitioned: dict[str, tuple[str, str]] = field(default_factory=dict)

    def partitions(self, name: str) -> dict[str, str]:
        """Partition columns of the fact that a dimension has too, with its name for them."""
        return {f: column for f, (dim, column) in self.partitioned.items() if dim == name}

    def dimensions(self) -> dict[str, tuple[DataFrame, str, str]]:
        """Name -> (frame, fact column, dimension key) of the dimensions there are."""
        every = {
            "hotels": (self.hotels, "hotel_id", "hotel_id"),
            "dates": (self.dates, "booking_date", "date_key"),
            "customers": (self.customers, "customer_id", "customer_id"),
        }
        return {name: part for name, part in every.items() if part[0] is not None}


def build_star(
    gold: DataFrame,
    columns: Sequence[str] = FCT_BOOKINGS.names,
    dimensions: Sequence[str] = ("hotels", "dates", "customers"),
) -> Star:
    """Star over a gold table. Pass a stored table: each part scans its own columns of it.

    A many-to-one relation needs one customer row per id, so repeated customers are
    reduced to one. Fewer columns of the fact and fewer dimensions need fewer gold columns.
    """
    make = {
        "hotels": dim_hotels,
        "dates": dim_date,
        "customers": lambda rows: first_per_key(dim_customers(rows), "customer_id", []),
    }
    return Star(fct_bookings(gold, columns), **{name: make[name](gold) for name in dimensions})


FACT_MONTH = "booking_month"
FACT_BUCKETS = 16
# A bucket is sorted in one task where it is joined; more facts than this get more buckets.
BUCKET_ROWS = 2_000_000


def store_star(star: Star, prefix: str, folder: str, buckets: int = FACT_BUCKETS) -> Star:
    """A star as stored tables that joins and selections can use as they lie.

    Facts are partitioned by booking month, so a selection of days reads its months only,
    and bucketed and sorted by customer like the customers themselves, the one dimension
    that grows with the facts: their join moves neither side. Rows of a bucket and month are
    brought to one task before writing, so a partition has one file for each bucket, and no
    task has to hold a whole bucket. ``buckets`` is the least number; it grows with the facts.
    """
    spark = star.fact.sparkSession
    month = F.date_format("booking_date", "yyyy-MM")
    buckets = max(buckets, -(-star.fact.count() // BUCKET_ROWS))

    def stored(df: DataFrame, name: str, bucketed: bool, partition: str | None = None) -> DataFrame:
        if bucketed:
            # The hash that tells a row's bucket.
            bucket = F.pmod(F.hash("customer_id"), F.lit(buckets))
            df = df.repartition(bucket, *([partition] if partition else []))
        writer = df.write.mode("overwrite").format("parquet").option("path", f"{folder}/{name}")
        if bucketed:
            writer = writer.bucketBy(buckets, "customer_id").sortBy("customer_id")
        if partition:
            writer = writer.partitionBy(partition)
        writer.saveAsTable(f"{prefix}_{name}")
        return spark.table(f"{prefix}_{name}")

    return Star(
        stored(star.fact.withColumn(FACT_MONTH, month), "fct_bookings", True, FACT_MONTH),
        stored(star.hotels, "dim_hotels", False),
        stored(star.dates, "dim_date", False),
        stored(star.customers, "dim_customers", True),
        {FACT_MONTH: ("dates", "year_month")},
    )


def star_join(star: Star, columns: dict[str, list[str]]) -> DataFrame:
    """Facts with chosen dimension columns; facts without a match keep blank members."""
    df = star.fact
    for name, (dim, fact_key, dim_key) in star.dimensions().items():
        wanted = columns.get(name, [])
        if not wanted:
            continue
        part = dim.select(
            F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(f"{name}_{c}") for c in wanted]
        )
        df = df.join(part, df[fact_key] == part["_dim_key"], "left").drop("_dim_key")
    return df
