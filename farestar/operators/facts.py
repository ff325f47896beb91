"""Fact tables: cleaned trips aggregated to their reporting grain.

Each fact is one partial and one final hash aggregate around one shuffle.  The partial side
folds a hot cell to one row per task, so no key needs salting.  The date key is built from the
calendar columns of the cleaned table, which spares the scan its widest column, the pickup
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farestar.functions.calendar import date_key
from farestar.functions.numbers import average, integer_average, ratio_or_zero, sum_cents, total
from farestar.operators.cleaning import CORRECTION, VALID

_KEYS = (
    f"{date_key('trip_year', 'trip_month', 'trip_day')} AS date_key",
    "payment_type AS payment_key",
    "pickup_location_id",
)

# Fact measure -> cleaned amount it sums, in output order.
_SUMMED = {
    "total_revenue": "total_amount",
    "total_fare": "fare_amount",
    "total_tips": "tip_amount",
    "total_tolls": "tolls_amount",
    "total_congestion": "congestion_surcharge",
    "total_extra": "extra_amount",
    "total_mta_tax": "mta_tax",
    "total_improvement": "improvement_surcharge",
    "total_airport_fee": "airport_fee",
    "total_distance_miles": "trip_distance_miles",
}
# Fact measure -> the sum it is the average of.
_AVERAGED = {
    "avg_trip_cost": "total_revenue",
    "avg_fare": "total_fare",
    "avg_tip": "total_tips",
    "avg_distance_miles": "total_distance_miles",
}


def fact_trips(silver: DataFrame) -> DataFrame:
    """Valid trips by day, payment type, pickup zone, dropoff zone and hour."""
    keys = ("date_key", "payment_key", "pickup_location_id", "dropoff_location_id", "pickup_hour")
    measures = (
        "count(*) AS trip_count",
        "sum(passenger_count) AS total_passengers",
        "sum(trip_duration_minutes) AS total_duration_minutes",
        *(f"{sum_cents(amount)} AS {name}" for name, amount in _SUMMED.items()),
        # Averages skip NULL amounts, so each needs its own count.
        *(f"count({_SUMMED[name]}) AS {name}_rows" for name in _AVERAGED.values()),
    )
    cells = (
        silver.where(f"trip_status = '{VALID}'")
        .selectExpr(
            *_KEYS, "dropoff_location_id", "pickup_hour",
            "passenger_count", "trip_duration_minutes", *_SUMMED.values(),
        )
        .groupBy(*keys)
        .agg(*map(F.expr, measures))
    )
    return cells.selectExpr(
        *keys,
        "trip_count",
        "total_passengers",
        *(f"{total(name)} AS {name}" for name in _SUMMED),
        "total_duration_minutes",
        *(f"{average(name, f'{name}_rows')} AS {alias}" for alias, name in _AVERAGED.items()),
        f"{integer_average('total_duration_minutes', 'trip_count')} AS avg_duration_minutes",
        f"{ratio_or_zero('total_revenue', 'total_distance_miles')} AS revenue_per_mile",
    )


def fact_corrections(silver: DataFrame) -> DataFrame:
    """Corrections by day, payment type and pickup zone."""
    keys = ("date_key", "payment_key", "pickup_location_id")
    measures = (
        "count(*) AS correction_count",
        f"{sum_cents('fare_amount')} AS fare",
        f"{sum_cents('total_amount')} AS amount",
        "count(fare_amount) AS fare_rows",
    )
    return (
        silver.where(f"trip_status = '{CORRECTION}'")
        .selectExpr(*_KEYS, "fare_amount", "total_amount")
        .groupBy(*keys)
        .agg(*map(F.expr, measures))
        .selectExpr(
            *keys,
            "correction_count",
            f"{total('fare')} AS total_refunded_fare",
            f"{total('amount')} AS total_refunded_amount",
            f"{average('fare', 'fare_rows')} AS avg_refunded_fare",
        )
    )
