"""Booking-shaped view of the given order tables, with realistic dirt.

One booking per line item: the line holds prices, its order the customer and the booking
day, its supplier is the hotel. Every expression is portable SQL text that gives the same
value in Spark and in the checking engine. A caller names the columns it needs, and only
tables behind those columns are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.columns import FEW, apart

# --- Fixed values: invented country of each nation key; the last has no currency --------
COUNTRIES = [
    "ARGENTINA", "AUSTRALIA", "AUSTRIA", "BRAZIL", "CANADA", "CHINA", "CZECH REPUBLIC",
    "DENMARK", "EGYPT", "FRANCE", "GERMANY", "INDIA", "ITALY", "JAPAN", "KENYA", "MEXICO",
    "NORWAY", "PERU", "POLAND", "SPAIN", "SWEDEN", "TURKEY", "UNITED KINGDOM",
    "UNITED STATES", "ATLANTIS",
]
# Rates of the daily service before their day-of-month factor.
DAILY_RATES = [
    ("EUR", 0.9), ("AUD", 1.5), ("BRL", 5.0), ("CAD", 1.35), ("CNY", 7.2), ("JPY", 150.0),
    ("GBP", 0.8),
]
# The data ends in 2001, so the year guard of the checks stands at 2000.
LAST_YEAR = 2000


def _country(nation_key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(COUNTRIES))
    return f"(CASE {nation_key} {cases} END)"


K = "(l_orderkey * 7 + l_linenumber)"
BD = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
SD = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
_SUPP = "CAST(l_suppkey AS STRING)"
_CUST = "CAST(o_custkey AS STRING)"


def _slashed(day: str, first: int, second: int) -> str:
    return f"substr({day}, {first}, 2) || '/' || substr({day}, {second}, 2) || '/' || substr({day}, 1, 4)"


# Column -> (tables joined to the line item, expression over k and table columns).
BOOKING_COLUMNS: dict[str, tuple[str, str]] = {
    "booking_id": ("", "'bk-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"),
    "hotel_id": ("", "CASE WHEN k % 97 = 0 THEN '--' WHEN k % 89 = 0 THEN NULL WHEN k % 83 = 0 THEN 'null'"
                     f" ELSE '?h' || {_SUPP} || '_' END"),
    "customer_id": ("o", f"'c' || {_CUST}"),
    "hotel_name": ("s", "CASE WHEN k % 29 = 0 THEN '' ELSE s_name END"),
    "country": ("s", f"CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN '!' || lower({_country('s_nationkey')}) || '#'"
                     f" ELSE {_country('s_nationkey')} END"),
    "city": ("s", "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN ''"
                  " ELSE 'CITY ' || CAST(s_nationkey AS STRING) END"),
    "hotel_type": ("", "CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '?Resort!' ELSE l_returnflag || ' type' END"),
    "hotel_facilities": ("", "CASE WHEN k % 12 = 0 THEN NULL ELSE 'wifi, pool \"' || l_linestatus || '\"' END"),
    "nearby_attractions": ("", f"CASE WHEN k % 14 = 0 THEN '---' ELSE 'museum ' || {_SUPP} END"),
    "website": ("", f"CASE WHEN k % 16 = 0 THEN '' ELSE 'www.h' || {_SUPP} || '.example' END"),
    "first_name": ("o", f"'_First' || {_CUST}"),
    "last_name": ("o", f"'Last' || {_CUST} || '!'"),
    "full_name": ("oc", "c_name"),
    "email": ("o", f"CASE WHEN k % 18 = 0 THEN '' ELSE 'c' || {_CUST} || '@mail.example' END"),
    "phone": ("o", "'#' || CAST(1000000 + o_custkey AS STRING)"),
    "birth_date": ("", "CASE k % 4 WHEN 0 THEN '30/02/1980' WHEN 1 THEN '25/12/1975' WHEN 2 THEN '1990/07/08' ELSE '1985-01-31' END"),
    "gender": ("", "CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN '?' ELSE NULL END"),
    "country_customer": ("oc", f"CASE WHEN k % 10 = 0 THEN NULL WHEN k % 15 = 1 THEN 'UNKNOWN' ELSE {_country('c_nationkey')} END"),
    "city_customer": ("oc", "CASE WHEN k % 14 = 0 THEN NULL WHEN k % 22 = 1 THEN 'UNKNOWN' WHEN k % 26 = 3 THEN '#'"
                            " ELSE 'CITY ' || CAST(c_nationkey AS STRING) END"),
    "address": ("", f"CASE WHEN k % 21 = 0 THEN NULL ELSE {_SUPP} || ' Main St.' END"),
    "postal_code": ("", "CASE WHEN k % 20 = 0 THEN '##' ELSE CAST(10000 + l_suppkey AS STRING) END"),
    "language_preference": ("", "'en|'"),
    "loyalty_level_customer": ("oc", "CASE WHEN k % 6 = 0 THEN '' ELSE c_mktsegment END"),
    "registration_date": ("o", BD),
    "marketing_consent": ("", "CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END"),
    "booking_date": ("o", f"CASE WHEN k % 6 = 0 THEN {_slashed(BD, 6, 9)} WHEN k % 6 = 1 THEN {_slashed(BD, 9, 6)}"
                          f" WHEN k % 6 = 2 THEN replace({BD}, '-', '/') WHEN k % 6 = 3 AND k % 5 = 0 THEN 'n/a' ELSE {BD} END"),
    "checkin_date": ("", SD),
    "checkout_date": ("", f"CASE WHEN k % 9 = 0 THEN 'n/a' ELSE replace({SD}, '-', '/') END"),
    "nights": ("", "CAST(CAST(l_quantity AS INT) AS STRING)"),
    "room_type": ("", "CASE WHEN k % 10 = 0 THEN '' ELSE 'Room ' || l_returnflag END"),
    "booking_channel": ("", "CASE WHEN k % 11 = 1 THEN NULL ELSE '-' || l_linestatus || ' line-' END"),
    "special_requests": ("", "CASE WHEN k % 2 = 0 THEN '..late arrival..' ELSE NULL END"),
    "is_cancelled": ("o", "CASE o_orderstatus WHEN 'F' THEN 'True' ELSE 'False' END"),
    "cancellation_date": ("o", f"CASE o_orderstatus WHEN 'F' THEN {SD} ELSE '' END"),
    "cancellation_reason": ("o", "CASE o_orderstatus WHEN 'F' THEN '!!changed plans!!' ELSE NULL END"),
    "booking_status": ("o", "CASE o_orderstatus WHEN 'F' THEN '_Cancelled!' WHEN 'O' THEN 'Confirmed' ELSE 'Pending?' END"),
    "promotion_code": ("", "CASE WHEN k % 7 = 3 THEN '#PROMO' || CAST(k % 10 AS STRING) ELSE NULL END"),
    "booking_source": ("", "l_linestatus || ' web'"),
    "star_rating": ("", "CASE k % 9 WHEN 0 THEN ' five' WHEN 1 THEN 'THREE ' WHEN 2 THEN '4.5' WHEN 3 THEN '0' WHEN 4 THEN 'ten'"
                        " WHEN 5 THEN 'none' WHEN 6 THEN NULL WHEN 7 THEN '3' ELSE '9' END"),
    "total_rooms": ("", f"CASE k % 5 WHEN 0 THEN '-3' WHEN 1 THEN '9999' WHEN 2 THEN 'abc' ELSE CAST(l_suppkey + 20 AS STRING) END"),
    "total_price": ("", "CASE WHEN k % 19 = 0 THEN '-' || CAST(l_extendedprice AS STRING) WHEN k % 23 = 0 THEN 'n/a'"
                        " WHEN k % 15 = 2 THEN CAST(CAST(l_quantity AS INT) * 9 AS STRING) ELSE CAST(l_extendedprice AS STRING) END"),
    "room_price": ("", "CASE WHEN k % 27 = 0 THEN 'free' ELSE CAST(l_extendedprice AS STRING) END"),
    "tax_amount": ("", "CASE WHEN k % 31 = 0 THEN NULL ELSE CAST(l_tax AS STRING) END"),
    "service_fee": ("", "CASE WHEN k % 37 = 0 THEN 'abc' ELSE CAST(l_tax AS STRING) END"),
    "paid_amount": ("", "CASE WHEN k % 33 = 0 THEN '' ELSE CAST(l_extendedprice AS STRING) END"),
    "discount_amount": ("", "CASE WHEN k % 41 = 0 THEN '-5' WHEN k % 43 = 0 THEN NULL ELSE CAST(l_discount AS STRING) END"),
    "payment_status": ("", "CASE WHEN k % 4 = 0 THEN '?' ELSE 'Paid' END"),
    "payment_method": ("o", "CASE WHEN k % 3 = 0 THEN '' ELSE o_orderpriority END"),
    "review_date": ("", _slashed(SD, 6, 9)),
    "is_verified_review": ("", "CASE WHEN k % 3 = 1 THEN 'True' ELSE '' END"),
    "reviewer_location": ("", "CASE WHEN k % 5 = 2 THEN '' ELSE 'loc ' || l_returnflag END"),
    "stay_date": ("", SD),
    "trip_type": ("", "CASE k % 3 WHEN 0 THEN 'Business' WHEN 1 THEN '!Leisure' ELSE NULL END"),
    "room_type_reviewed": ("", "CASE WHEN k % 8 = 5 THEN '..' ELSE 'Room ' || l_returnflag END"),
    "review_rating": ("", "CASE k % 7 WHEN 0 THEN 'Four' WHEN 1 THEN '5' WHEN 2 THEN '2.9' WHEN 3 THEN '11' WHEN 4 THEN '1e0'"
                          " WHEN 5 THEN '' ELSE ' 1 ' END"),
    "created_timestamp": ("o", f"{BD} || ' 08:00:00'"),
    "updated_timestamp": ("", f"'#' || {SD} || ' 09:30:00'"),
    "created_by": ("", "'_batch_'"),
    "source_system": ("", "CASE WHEN k % 6 = 5 THEN NULL ELSE 'pms' END"),
    "created_at": ("o", BD),
    "updated_at": ("", SD),
    "hotel_description": ("s", "CASE WHEN k % 10 = 0 THEN 'Rooms by' || chr(10) || s_name ELSE 'Rooms by ' || s_name END"),
    "latitude": ("s", "CASE WHEN k % 50 = 0 THEN NULL ELSE CAST(s_nationkey * 1.5e0 AS STRING) END"),
    "longitude": ("s", "CAST(s_nationkey * 2.25e0 - 20.0e0 AS STRING)"),
}


# Parts of these expressions that are computed once, where their table is read: a date is
# slow to write as text, and a list of all countries makes much code for each mention.
_PARTS = {
    "lineitem": {"_sd": SD},
    "orders": {"_bd": BD},
    "supplier": {"_s_country": _country("s_nationkey")},
    "customer": {"_c_country": _country("c_nationkey")},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_bookings(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, keep: Sequence[str] = (),
    every_table: bool = False,
) -> DataFrame:
    """Dirty bookings as text; ``keep`` adds line-item columns (or ``k``) unchanged.

    ``every_table`` joins all tables, so that repeated keys repeat the same rows whatever
    columns are named.
    """
    columns = list(BOOKING_COLUMNS) if columns is None else list(columns)
    needs = set("soc" if every_table else "".join(BOOKING_COLUMNS[c][0] for c in columns))

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name).withColumns({c: F.expr(e) for c, e in _PARTS[name].items()})

    df = read("lineitem")
    if "s" in needs:
        supplier = read("supplier")
        df = df.join(supplier, df["l_suppkey"] == supplier["s_suppkey"], "left")
    if "o" in needs:
        orders = read("orders")
        if "c" in needs:
            customer = read("customer")
            orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"], "left")
    df = df.withColumn("k", F.expr(K))
    made = [F.expr(_by_parts(BOOKING_COLUMNS[c][1])) for c in columns]
    if len(made) > FEW:
        made[0] = apart(made[0])
    return df.select(*[m.alias(c) for m, c in zip(made, columns, strict=True)], *keep)


def _by_parts(expression: str) -> str:
    for parts in _PARTS.values():
        for name, part in parts.items():
            expression = expression.replace(part, name)
    return expression


def in_batch() -> Column:
    """The 70 % of lines that arrive in batch; ``k`` must be kept by ``raw_bookings``."""
    return F.col("k") % 10 < 7


def city_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.expr("'CITY ' || CAST(n_nationkey AS STRING)").alias("city"),
        F.expr(_country("n_nationkey")).alias("country"),
    )


def country_capital(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.expr(_country("n_nationkey")).alias("country"),
        F.expr("'CAPITAL ' || CAST(n_nationkey AS STRING)").alias("capital"),
    )


def _days(df: DataFrame, column: str, name: str) -> DataFrame:
    """Every day from the first to the last one of a column."""
    day = F.col(column).cast("date")
    bounds = df.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi")).alias(name))


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working-day exchange rates over the booking period; no rate at weekends."""
    days = _days(table(spark, sf_dir, "orders"), "o_orderdate", "rate_date").filter(
        ~F.dayofweek("rate_date").isin(1, 7)
    )
    quotes = F.array(
        *[F.struct(F.lit(c).alias("currency_code"), F.lit(r).alias("base")) for c, r in DAILY_RATES]
    )
    return days.select("rate_date", F.inline(quotes)).select(
        "rate_date",
        "currency_code",
        F.expr("base * (1 + (day(rate_date) % 7) / 100.0e0)").alias("usd_rate"),
    )


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather of every city outside region 4, which the service does not cover."""
    lines = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    first = lines.agg(F.min(day)).scalar()
    last = lines.agg(F.max(day)).scalar()
    cities = table(spark, sf_dir, "nation").filter("n_regionkey <> 4")
    rows = cities.withColumn("_span", F.sequence(first, last)).select(
        "n_nationkey", F.explode("_span").alias("weather_date")
    )
    return rows.select(
        "weather_date",
        F.expr("'CITY ' || CAST(n_nationkey AS STRING)").alias("city_name"),
        F.expr("CAST(10 + (n_nationkey + day(weather_date)) % 20 AS DOUBLE)").alias("temp_max"),
        F.expr(
            "CASE (n_nationkey + day(weather_date)) % 4 WHEN 0 THEN 1.5e0 WHEN 1 THEN 0.5e0 ELSE 0.0e0 END"
        ).alias("rain_sum"),
    )
