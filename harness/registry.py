"""One query per operator, each over the whole tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from farestar.functions.calendar import date_key_of
from farestar.functions.numbers import blank_as_zero, code, money
from farestar.lake import DIM_DATE, DIM_PAYMENT_TYPE, FACT_CORRECTIONS, FACT_TRIPS
from farestar.operators import dimensions, facts, profiles, quality
from farestar.operators.cleaning import (
    CLEANED_COLUMNS, DROPOFF, DURATION, KEEP_RULES, PICKUP, TRIP_STATUS, clean_trips,
)
from farestar.operators.star import orphan_keys, star_join
from farestar.plans import reports
from farestar.sources import bronze, months
from harness.trips import (
    gold_tables, landed_lake, landing_report, raw_fields, raw_trips, silver_trips,
)

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Decimals and dates as text, so two engines' results compare digit by digit."""

    def column(field) -> str:
        if isinstance(field.dataType, (DecimalType, DateType)):
            return f"CAST({field.name} AS STRING) AS {field.name}"
        return field.name

    return df.selectExpr(*map(column, df.schema.fields))


# --- files -----------------------------------------------------------------------------------


def _grid_of(raw: DataFrame) -> DataFrame:
    """All months of the years in which the raw table has trips inside the accepted dates."""
    bounds = raw.where(KEEP_RULES["date_range"]).agg(
        F.expr(f"min(year({PICKUP})) AS start_year"), F.expr(f"max(year({PICKUP})) AS end_year")
    )
    return months.month_grid(bounds)


def month_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid_of(raw_trips(spark, sf_dir))


def month_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.with_paths(months.months_of(raw_trips(spark, sf_dir), PICKUP))


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    return months.missing_months(_grid_of(raw), months.months_of(raw, PICKUP))


def landed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.landed_months(spark, landed_lake(spark, sf_dir)).select("year", "month")


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.read_bronze(spark, landed_lake(spark, sf_dir))


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published view, read by name."""
    bronze.create_raw_view(spark, landed_lake(spark, sf_dir), "vw_yellow_taxi_raw")
    return spark.table("vw_yellow_taxi_raw").groupBy("source_file").agg(
        F.expr("count(*) AS trips"), F.expr("count(RatecodeID) AS rated")
    )


def landed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of all months of the years of the trips, landed again year by year."""
    return landing_report(spark, sf_dir).select("year", "month", "status")


def bronze_airport_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged fee of the landed files, whose casing differs by year."""
    raw = bronze.read_bronze(spark, landed_lake(spark, sf_dir))
    return raw.groupBy("source_year", "airport_fee").agg(F.expr("count(*) AS trips"))


def _projected(*expressions: str) -> Query:
    """Expressions over all raw rows: the inputs of an operator next to its result."""
    return lambda spark, sf_dir: raw_trips(spark, sf_dir).selectExpr(*expressions)


def airport_fee_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = raw_fields(spark, sf_dir).select(PICKUP, "airport_fee_lower", "airport_fee_upper")
    return fields.selectExpr("*", f"{bronze.AIRPORT_FEE} AS airport_fee")


# --- cleaning --------------------------------------------------------------------------------

_AMOUNTS = (
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee",
)


def _new(*columns: str) -> tuple[str, ...]:
    """The expressions of silver columns, named apart from raw columns of the same name."""
    return tuple(f"{CLEANED_COLUMNS[name]} AS new_{name}" for name in columns)


def cleaned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(raw_trips(spark, sf_dir))


_FILTER_INPUTS = {
    "vendor": ("VendorID",),
    "distance": ("trip_distance",),
    "zones": ("PULocationID", "DOLocationID"),
    "date_range": (PICKUP,),
    "time_order": (PICKUP, DROPOFF),
    "duration": (PICKUP, DROPOFF),
}


def _filtered(rule: str) -> Query:
    """The rows that one cleaning rule keeps, reduced to the columns it reads."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return raw_trips(spark, sf_dir).where(KEEP_RULES[rule]).select(*_FILTER_INPUTS[rule])

    return query


def _profile(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(raw_trips(spark, sf_dir))


# --- star schema -----------------------------------------------------------------------------


def _dates_of(silver: DataFrame) -> DataFrame:
    """The calendar of all years in which the cleaned table has trips."""
    bounds = silver.agg(
        F.expr("make_date(min(trip_year), 1, 1) AS first_day"),
        F.expr("make_date(max(trip_year), 12, 31) AS last_day"),
    )
    return dimensions.dim_date(bounds)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_of(silver_trips(spark, sf_dir))


def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension with the number of cleaned trips of each payment type."""
    used = silver_trips(spark, sf_dir).groupBy("payment_type").agg(F.expr("count(*) AS used"))
    types = dimensions.dim_payment_type(spark)
    return types.join(used, F.expr("payment_key = payment_type"), "left").selectExpr(
        "payment_key", "payment_name", "payment_category", "coalesce(used, 0) AS trips"
    )


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_trips(silver_trips(spark, sf_dir))


def fact_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_corrections(silver_trips(spark, sf_dir))


def _star(fact: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_tables(spark, sf_dir)
        return star_join(gold[fact], gold[DIM_DATE], gold[DIM_PAYMENT_TYPE])

    return query


def star_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(FACT_TRIPS)(spark, sf_dir).select(
        "date_key", "full_date", "day_name", "year_month", "quarter", "payment_key",
        "payment_name", "payment_category", "pickup_location_id", "dropoff_location_id",
        "pickup_hour", "trip_count", "total_revenue",
    )


def star_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(FACT_CORRECTIONS)(spark, sf_dir).select(
        "date_key", "full_date", "month_name", "year_month", "weekday_num", "payment_key",
        "payment_name", "payment_category", "pickup_location_id", "correction_count",
        "total_refunded_amount",
    )


# --- rules -----------------------------------------------------------------------------------


def quality_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_silver(silver_trips(spark, sf_dir), raw_trips(spark, sf_dir))


def quality_data_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_data_loss(silver_trips(spark, sf_dir), raw_trips(spark, sf_dir))


def quality_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_tables(spark, sf_dir)
    return quality.quality_gold(
        gold[DIM_DATE], gold[DIM_PAYMENT_TYPE], gold[FACT_TRIPS], gold[FACT_CORRECTIONS],
        silver_trips(spark, sf_dir),
    )


def quality_cross_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_tables(spark, sf_dir)
    return quality.quality_cross_layer(
        gold[FACT_TRIPS], gold[FACT_CORRECTIONS], silver_trips(spark, sf_dir)
    )


def dim_date_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.date_key_counts(dim_date(spark, sf_dir))
    return counts.selectExpr(
        "G01 AS days", "G02 AS days_outside", "G03 AS most_rows_of_a_key"
    )


def _orphans(fact: str) -> Query:
    """Fact rows without a payment type, for the whole dimension and for one of its categories."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_tables(spark, sf_dir)
        return quality.orphan_counts(
            gold[fact], gold[DIM_PAYMENT_TYPE],
            {"whole": "true", "others": "payment_category = 'Others'"},
        )

    return query


def _keys_outside_others(fact: str) -> Query:
    """Payment keys, with their fact rows, that are NOT IN one category of the dimension."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_tables(spark, sf_dir)
        others = gold[DIM_PAYMENT_TYPE].where("payment_category = 'Others'")
        return orphan_keys(gold[fact], others)

    return query


# --- reports ---------------------------------------------------------------------------------


def _report(build: Callable[..., DataFrame], *tables: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_tables(spark, sf_dir)
        return build(*(gold[name] for name in tables))

    return query


_QUERIES: dict[str, Query] = {
    "month_grid": month_grid,
    "month_paths": month_paths,
    "missing_months": missing_months,
    "landed_months": landed_months,
    "bronze_scan": bronze_scan,
    "raw_view": raw_view,
    "landed_years": landed_years,
    "bronze_airport_fee": bronze_airport_fee,
    "airport_fee_merge": airport_fee_merge,
    "silver_trips": cleaned_trips,
    "silver_money": _projected(*_AMOUNTS, *(f"{money(a)} AS new_{a}" for a in _AMOUNTS)),
    "silver_codes": _projected(
        *bronze.CODE_FIELDS,
        *(f"{code(blank_as_zero(c))} AS new_{c}" for c in bronze.CODE_FIELDS),
    ),
    "silver_null_fix": _projected(
        *profiles.REPAIRED_COLUMNS,
        f"coalesce({code(blank_as_zero('passenger_count'))}, 1) AS new_passenger_count",
        f"coalesce({code(blank_as_zero('RatecodeID'))}, 1) AS new_rate_code_id",
        *_new(
            "store_and_fwd_flag",
            "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
        ),
    ),
    "silver_duration": _projected(PICKUP, DROPOFF, f"{DURATION} AS trip_duration_minutes"),
    "silver_calendar": _projected(
        PICKUP, *_new("trip_year", "trip_month", "trip_day", "trip_weekday", "pickup_hour")
    ),
    "silver_trip_status": _projected(
        "fare_amount", "total_amount", f"{TRIP_STATUS} AS trip_status"
    ),
    "date_key": _projected(PICKUP, f"{date_key_of(PICKUP)} AS date_key"),
    **{f"filter_{rule}": _filtered(rule) for rule in _FILTER_INPUTS},
    "filter_profile": _profile(profiles.filter_profile),
    "null_profile": _profile(profiles.null_profile),
    "status_profile": _profile(profiles.status_profile),
    "dim_date": dim_date,
    "dim_payment_type": dim_payment_type,
    "fact_trips": fact_trips,
    "fact_corrections": fact_corrections,
    "star_trips": star_trips,
    "star_corrections": star_corrections,
    "quality_silver": quality_silver,
    "quality_gold": quality_gold,
    "quality_cross_layer": quality_cross_layer,
    "quality_data_loss": quality_data_loss,
    "dim_date_key_unique": dim_date_key_unique,
    "orphan_payment_trips": _orphans(FACT_TRIPS),
    "orphan_payment_corrections": _orphans(FACT_CORRECTIONS),
    "orphan_keys_trips": _keys_outside_others(FACT_TRIPS),
    "orphan_keys_corrections": _keys_outside_others(FACT_CORRECTIONS),
    "report_overview": _report(reports.overview, FACT_TRIPS, DIM_DATE, DIM_PAYMENT_TYPE),
    "report_revenue": _report(reports.revenue, FACT_TRIPS, DIM_DATE, DIM_PAYMENT_TYPE),
    "report_zones": _report(reports.zones, FACT_TRIPS),
    "report_temporal": _report(reports.temporal, FACT_TRIPS, DIM_DATE),
    "report_corrections": _report(
        reports.corrections, FACT_CORRECTIONS, DIM_DATE, DIM_PAYMENT_TYPE
    ),
}


def _portable(query: Query) -> Query:
    return lambda spark, sf_dir: portable(query(spark, sf_dir))


def plain_queries() -> dict[str, Query]:
    """The queries as an application runs them, decimals and dates in their own types."""
    return dict(_QUERIES)


def all_queries() -> dict[str, Query]:
    return {name: _portable(query) for name, query in _QUERIES.items()}
