"""Report queries over the star schema.

Averages of a fact are not additive, so every ratio divides summed totals.  Each query joins
two broadcast-size dimensions inside the scan stage and shuffles partial sums once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farestar.operators.star import star_join


def _sum(name: str, alias: str | None = None) -> Column:
    return F.sum(name).alias(alias or name)


def _per(numerator: str, denominator: str) -> Column:
    """Ratio of two summed columns as DOUBLE; NULL when there is nothing to divide by."""
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def overview(trips: DataFrame, dates: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Headline numbers by month and payment category."""
    return (
        star_join(trips, dates, payment_types)
        .groupBy("year_month", "payment_category")
        .agg(
            _sum("trip_count", "trips"),
            _sum("total_passengers", "passengers"),
            _sum("total_revenue", "revenue"),
            _sum("total_tips", "tips"),
        )
        .withColumn("revenue_per_trip", _per("revenue", "trips"))
        .withColumn("tips_share", _per("tips", "revenue"))
    )


def revenue(trips: DataFrame, dates: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Revenue components by quarter and payment type."""
    components = (
        "total_revenue", "total_fare", "total_tips", "total_tolls", "total_congestion",
        "total_extra", "total_mta_tax", "total_improvement", "total_airport_fee",
    )
    return (
        star_join(trips, dates, payment_types)
        .groupBy("year", "quarter", "payment_name")
        .agg(_sum("trip_count", "trips"), *(_sum(name) for name in components))
    )


def zones(trips: DataFrame) -> DataFrame:
    """Trips, revenue and miles by pickup zone."""
    return (
        trips.groupBy("pickup_location_id")
        .agg(
            _sum("trip_count", "trips"),
            _sum("total_revenue", "revenue"),
            _sum("total_distance_miles", "miles"),
        )
        .withColumn("revenue_per_mile", _per("revenue", "miles"))
    )


def temporal(trips: DataFrame, dates: DataFrame) -> DataFrame:
    """Trips and revenue by weekday and hour."""
    return (
        trips.join(dates, "date_key", "left")
        .groupBy("weekday_num", "day_name", "pickup_hour")
        .agg(_sum("trip_count", "trips"), _sum("total_revenue", "revenue"))
    )


def corrections(fact: DataFrame, dates: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Refunded amounts by month and payment type."""
    return (
        star_join(fact, dates, payment_types)
        .groupBy("year_month", "payment_name")
        .agg(
            _sum("correction_count", "corrections"),
            _sum("total_refunded_fare", "refunded_fare"),
            _sum("total_refunded_amount", "refunded_amount"),
        )
    )
