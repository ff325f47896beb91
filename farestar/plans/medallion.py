"""Builds the three layers in order; every table is written once and read by what follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farestar import lake as names
from farestar.lake import Lake
from farestar.operators import cleaning, dimensions, facts, quality
from farestar.sources.bronze import read_bronze_trips
from farestar.sources.tables import create_table_as, read_table


def build_silver(spark: SparkSession, lake: Lake, overwrite: bool = False) -> DataFrame:
    """Raw months -> cleaned trips.  Map-only, from scan to write."""
    raw = read_bronze_trips(spark, lake)
    return create_table_as(cleaning.clean_trips(raw), lake.silver_trips, overwrite)


def build_gold(spark: SparkSession, lake: Lake, overwrite: bool = False) -> dict[str, DataFrame]:
    """Cleaned trips -> the four star-schema tables.

    Two scans of the cleaned table, one for each fact: both push their status filter and their
    own few columns into the scan, which costs less than keeping the table in memory.
    """
    silver = read_table(spark, lake.silver_trips)
    tables = {
        names.DIM_DATE: dimensions.dim_date(dimensions.date_bounds(spark)),
        names.DIM_PAYMENT_TYPE: dimensions.dim_payment_type(spark).coalesce(1),
        names.FACT_TRIPS: facts.fact_trips(silver),
        names.FACT_CORRECTIONS: facts.fact_corrections(silver),
    }
    return {
        name: create_table_as(df, lake.gold_table(name), overwrite) for name, df in tables.items()
    }


def read_gold(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    tables = (names.DIM_DATE, names.DIM_PAYMENT_TYPE, names.FACT_TRIPS, names.FACT_CORRECTIONS)
    return {name: read_table(spark, lake.gold_table(name)) for name in tables}


def check_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    raw = read_bronze_trips(spark, lake)
    return quality.quality_silver(read_table(spark, lake.silver_trips), raw)


def check_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    gold = read_gold(spark, lake)
    return quality.quality_gold(
        gold[names.DIM_DATE],
        gold[names.DIM_PAYMENT_TYPE],
        gold[names.FACT_TRIPS],
        gold[names.FACT_CORRECTIONS],
        read_table(spark, lake.silver_trips),
    )
