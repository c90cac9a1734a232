"""Literal tables; their size is fixed, so joins may broadcast them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.constants import COUNTRY_CURRENCY, FALLBACK_RATES


def country_currency(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        COUNTRY_CURRENCY, "country_name string, currency_code_map string"
    )


def rate_structs(rates: list[tuple[str, float]] = FALLBACK_RATES):
    """The flat rates as one literal array, to be exploded beside each row of a frame."""
    return F.array(
        *[
            F.struct(F.lit(code).alias("currency_code"), F.lit(rate).alias("usd_rate"))
            for code, rate in rates
        ]
    )
