"""Calendar and payment-type dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farestar.functions.calendar import (
    date_key_of, month_name, weekday_name, weekday_number, year_month,
)

# First and last day of the published calendar.
FIRST_DAY, LAST_DAY = "2021-01-01", "2025-12-31"

# Payment code, name, category.
PAYMENT_TYPES = (
    (0, "Unknown", "Others"),
    (1, "Credit Card", "Credit Card"),
    (2, "Cash", "Cash"),
    (3, "No Charge", "Others"),
    (4, "Dispute", "Others"),
    (5, "Unknown", "Others"),
    (6, "Voided Trip", "Others"),
)


def date_bounds(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return spark.range(1).selectExpr(
        f"DATE'{first}' AS first_day", f"DATE'{last}' AS last_day"
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row for each day from ``first_day`` to ``last_day``, both included."""
    return bounds.selectExpr("explode(sequence(first_day, last_day)) AS full_date").selectExpr(
        f"{date_key_of('full_date')} AS date_key",
        "full_date",
        "year(full_date) AS year",
        "month(full_date) AS month",
        "day(full_date) AS day",
        f"{weekday_name('full_date')} AS day_name",
        f"{month_name('full_date')} AS month_name",
        f"{year_month('full_date')} AS year_month",
        f"{weekday_number('full_date')} AS weekday_num",
        "quarter(full_date) AS quarter",
    )


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_TYPES, "payment_key int, payment_name string, payment_category string"
    )
