"""Typed contracts of the layers, and the cast of a frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _contract(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind], True) for name, kind in columns])


# --- Fixed values: columns and types of the layers, in order ------------------------------

FCT_BOOKINGS = _contract(
    ("booking_id", "string"),
    ("customer_id", "string"),
    ("hotel_id", "string"),
    ("total_price_usd", "double"),
    ("room_price", "double"),
    ("tax_amount", "double"),
    ("service_fee", "double"),
    ("discount_amount", "double"),
    ("checkin_date", "date"),
    ("checkout_date", "date"),
    ("nights", "string"),
    ("booking_date", "date"),
    ("full_name", "string"),
    ("hotel_name", "string"),
    ("country_name", "string"),
    ("booking_status", "string"),
    ("temp_max", "double"),
    ("is_rainy", "boolean"),
    ("price_category", "string"),
    ("star_rating", "int"),
)

DIM_CUSTOMERS = _contract(
    ("customer_id", "string"),
    ("first_name", "string"),
    ("last_name", "string"),
    ("full_name", "string"),
    ("email", "string"),
    ("gender", "string"),
    ("loyalty_level_customer", "string"),
    ("marketing_consent", "string"),
    ("registration_date", "string"),
)

DIM_DATE = _contract(
    ("date_key", "date"),
    ("year", "int"),
    ("month", "int"),
    ("month_name", "string"),
    ("quarter", "int"),
    ("week_of_year", "int"),
    ("day_of_week_name", "string"),
    ("is_weekend", "int"),
    ("year_month", "string"),
)

DIM_HOTELS = _contract(
    ("hotel_id", "string"),
    ("hotel_name", "string"),
    ("hotel_type", "string"),
    ("star_rating", "int"),
    ("hotel_facilities", "string"),
    ("nearby_attractions", "string"),
    ("hotel_description", "string"),
    ("country_name", "string"),
    ("city", "string"),
    ("address", "string"),
    ("postal_code", "string"),
    ("latitude", "string"),
    ("longitude", "string"),
)

WEATHER_PAYLOAD = T.StructType().add(
    "daily",
    T.StructType()
    .add("time", T.ArrayType(T.StringType()))
    .add("temperature_2m_max", T.ArrayType(T.DoubleType()))
    .add("rain_sum", T.ArrayType(T.DoubleType())),
)
RATES_PAYLOAD = T.StructType().add(
    "rates", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
)


def text_schema(columns: list[str]) -> T.StructType:
    """All-string schema, as raw bookings arrive."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the columns, order and types of a contract; bad text becomes NULL."""
    return df.select(
        [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields]
    )
