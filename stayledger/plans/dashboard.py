"""The stored queries behind the dashboard's cards, charts and slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.constants import DASHBOARD_CHECKIN_CUTOFF, UNKNOWN_GEO
from stayledger.functions.text import differs_keep_null
from stayledger.plans import measures as m
from stayledger.plans.star import Star


def kpi_card(star: Star, filters: m.Filters | None = None) -> DataFrame:
    """Four measures and the mean temperature in one row."""
    wanted = [
        m.total_revenue(), m.total_bookings(), m.avg_revenue(), m.cancellation_rate(),
        m.implicit("temp_max", "avg", "avg_temp_max"),
    ]
    return m.evaluate(star, (), wanted, filters)


def revenue_map(star: Star, filters: m.Filters | None = None) -> DataFrame:
    """Revenue by hotel city, all members."""
    return m.evaluate(star, ["hotels.city"], [m.total_revenue()], filters).withColumnRenamed(
        "hotels_city", "city"
    )


def revenue_by_city(star: Star, filters: m.Filters | None = None) -> DataFrame:
    """Revenue by hotel city, highest first, without the unknown city but with the blank."""
    known = revenue_map(star, filters).filter(differs_keep_null(F.col("city"), UNKNOWN_GEO))
    return known.orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("city"))


def revenue_by_month(star: Star, filters: m.Filters | None = None) -> DataFrame:
    total = m.implicit("total_price_usd", "sum")
    return (
        m.evaluate(star, ["dates.year_month"], [total], filters)
        .withColumnRenamed("dates_year_month", "year_month")
        .orderBy(F.asc_nulls_first("year_month"))
    )


def bookings_weather_combo(
    star: Star, before: str = DASHBOARD_CHECKIN_CUTOFF, filters: m.Filters | None = None
) -> DataFrame:
    """Bookings and mean temperature by check-in day and rain, before a cut-off day."""
    wanted = [m.implicit("booking_id", "count", "bookings"), m.implicit("temp_max", "avg")]
    early = F.col("checkin_date") < F.lit(before).cast("date")
    return m.evaluate(star, ["checkin_date", "is_rainy"], wanted, filters, early).orderBy(
        "checkin_date", "is_rainy"
    )


def bookings_by_category(star: Star, filters: m.Filters | None = None) -> DataFrame:
    """Bookings per price band with their share; there are only three bands to sum over."""
    counted = m.evaluate(
        star, ["price_category"], [m.implicit("booking_id", "count", "bookings")], filters
    )
    total = F.sum("bookings").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("share", F.try_divide(F.col("bookings"), total)).orderBy(
        F.desc("bookings"), "price_category"
    )


def slicer_values(df: DataFrame, column: str) -> DataFrame:
    """Members a slicer offers, blank included."""
    return df.select(column).distinct().orderBy(F.asc_nulls_first(column))
