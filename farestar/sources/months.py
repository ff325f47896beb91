"""The month calendar that drives ingestion, and the paths derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farestar.functions.calendar import two_digits
from farestar.lake import SOURCE_FOLDER, TRIP_DATASET

# The years the published pipeline asks for.
FIRST_YEAR, LAST_YEAR = 2021, 2025


def year_bounds(
    spark: SparkSession, start_year: int = FIRST_YEAR, end_year: int = LAST_YEAR
) -> DataFrame:
    return spark.range(1).selectExpr(f"{start_year} AS start_year", f"{end_year} AS end_year")


def month_grid(bounds: DataFrame) -> DataFrame:
    """(year STRING, month STRING '01'..'12') for every month of the bounded years."""
    years = bounds.selectExpr("explode(sequence(start_year, end_year)) AS y")
    return years.selectExpr("y", "explode(sequence(1, 12)) AS m").selectExpr(
        "CAST(y AS STRING) AS year", f"{two_digits('m')} AS month"
    )


def with_paths(grid: DataFrame) -> DataFrame:
    """Adds the relative source path and the bronze folder and file of each month."""
    return (
        grid.selectExpr(
            "*", f"concat('{TRIP_DATASET}_', year, '-', month, '.parquet') AS file_name"
        )
        .selectExpr(
            "*",
            f"concat('/{SOURCE_FOLDER}/', file_name) AS source_path",
            f"concat('{TRIP_DATASET}/', year, '/') AS sink_folder",
        )
    )


def months_of(trips: DataFrame, pickup: str) -> DataFrame:
    """(year, month, trips): the months in which the rows were picked up."""
    return (
        trips.selectExpr(
            f"CAST(year({pickup}) AS STRING) AS year", f"{two_digits(f'month({pickup})')} AS month"
        )
        .groupBy("year", "month")
        .count()
        .withColumnRenamed("count", "trips")
    )


def missing_months(grid: DataFrame, present: DataFrame) -> DataFrame:
    """Months of the grid that have no row in ``present`` (year, month)."""
    return grid.join(present.select("year", "month").distinct(), ["year", "month"], "left_anti")
