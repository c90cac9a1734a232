"""Silver bookings to gold: currency and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.constants import WEATHER_DEFAULTS
from stayledger.functions import numbers, text
from stayledger.operators.columns import beside
from stayledger.operators.joins import lookup_join
from stayledger.sources.literals import country_currency


# What rates and weather depend on.
ENRICHED_BY = ["booking_date", "checkin_date", "city", "country", "total_price"]


def with_currency_code(df: DataFrame) -> DataFrame:
    """Country name and currency code of the booking's country, NULL when unmapped."""
    mapping = F.broadcast(country_currency(df.sparkSession))
    return df.join(mapping, df["country"] == mapping["country_name"], "left")


def unique_rates(rates: DataFrame) -> DataFrame:
    """One rate per currency and day, the smallest winning, so that no booking is doubled."""
    return rates.groupBy("currency_code", F.col("rate_date").cast("date").alias("rate_date")).agg(
        F.min("usd_rate").alias("usd_rate")
    )


def join_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """The rate of the booking day as ``day_rate``."""
    day_rates = unique_rates(rates).select(
        F.col("rate_date").alias("_rate_date"),
        F.col("currency_code").alias("_rate_code"),
        F.col("usd_rate").alias("day_rate"),
    )
    return lookup_join(
        df, day_rates, [("currency_code_map", "_rate_code"), ("booking_date", "_rate_date")]
    )


def mean_rates(rates: DataFrame) -> DataFrame:
    return unique_rates(rates).groupBy("currency_code").agg(F.avg("usd_rate").alias("mean_rate"))


def join_mean_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """The mean rate of the currency as ``mean_rate``."""
    means = mean_rates(rates).withColumnRenamed("currency_code", "_mean_code")
    return lookup_join(df, means, [("currency_code_map", "_mean_code")])


def enrich_currency(
    silver: DataFrame, rates: DataFrame, rate_quote: str = "multiply"
) -> DataFrame:
    """Add country name, currency code, effective rate and price in dollars.

    ``rates`` should be a stored table, as it is read for the days and for the means.
    """
    df = silver.transform(with_currency_code).transform(join_rates, rates)
    df = df.transform(join_mean_rate, rates)
    rate = numbers.effective_rate(
        F.col("currency_code_map"), F.col("day_rate"), F.col("mean_rate")
    )
    df = df.withColumn("effective_rate", rate)
    price = numbers.convert(F.col("total_price"), F.col("effective_rate"), rate_quote)
    return df.withColumn("total_price_usd", price).drop("day_rate", "mean_rate")


def join_weather(df: DataFrame, weather: DataFrame, match: str = "exact") -> DataFrame:
    """Weather of the city on the check-in day; ``letters`` compares letters-only keys.

    Of several rows for a city (or its letters) and day the first by temperature, then rain,
    counts, so that no booking is doubled.
    """
    if match not in ("exact", "letters"):
        raise ValueError(f"unknown match: {match}")
    city = F.col("city_name") if match == "exact" else text.letters_key(F.col("city_name"))
    first = F.min(F.struct("temp_max", "rain_sum")).alias("_first")
    days = (
        weather.groupBy(
            city.alias("_weather_city"), F.col("weather_date").cast("date").alias("_weather_date")
        )
        .agg(first)
        .select("_weather_city", "_weather_date", "_first.temp_max", "_first.rain_sum")
    )
    if match == "exact":
        return lookup_join(df, days, [("city", "_weather_city"), ("checkin_date", "_weather_date")])
    keyed = df.withColumn("_city_key", text.letters_key(F.col("city")))
    on = [("_city_key", "_weather_city"), ("checkin_date", "_weather_date")]
    return lookup_join(keyed, days, on).drop("_city_key")


def enrich_weather(df: DataFrame, weather: DataFrame, match: str = "exact") -> DataFrame:
    """Add temperature and rain with defaults, the rain flag and the price band."""
    joined = join_weather(df, weather, match).fillna(WEATHER_DEFAULTS)
    return joined.withColumns(
        {
            "is_rainy": numbers.is_rainy(F.col("rain_sum")),
            "price_category": numbers.price_category(F.col("total_price_usd")),
        }
    )


def to_gold(
    silver: DataFrame, rates: DataFrame, weather: DataFrame, rate_quote: str = "multiply"
) -> DataFrame:
    def enriched(few: DataFrame) -> DataFrame:
        return enrich_weather(enrich_currency(few, rates, rate_quote), weather)

    return beside(silver, ENRICHED_BY, enriched)
