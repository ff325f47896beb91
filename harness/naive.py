"""Literal forms of some queries, to measure and to check the registered ones against.

No timings are published for this workload, so the literal translation is the baseline: one
scan for each rule, decimals summed as they are, built-in averages, text formatted per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from farestar.lake import DIM_PAYMENT_TYPE, FACT_CORRECTIONS, FACT_TRIPS
from farestar.operators.cleaning import KEEP_ALL, KEEP_RULES, clean_trips
from farestar.operators.quality import SILVER_RULES, SILVER_VIOLATIONS
from farestar.sources import bronze
from harness.oracle import _CROSS_TESTS, _TABLE_TESTS
from harness.registry import portable
from harness.trips import gold_tables, landed_lake, raw_trips, silver_trips

_DATE_KEY = "CAST(date_format(pickup_datetime, 'yyyyMMdd') AS INT)"


def _count_rule(name: str, table: str, condition: str = "true", wanted: str = "= 0") -> str:
    name = name.replace("{", "{{").replace("}", "}}")
    return (
        f"SELECT '{name}' AS test, if(count(*) {wanted}, 'PASS', 'FAIL') AS result,"
        f" CAST(count(*) AS STRING) AS details FROM {{{table}}} WHERE {condition}"
    )


def quality_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighteen scans of the cleaned table and one of the raw one."""
    rules = [
        _count_rule(r.name, "silver", SILVER_VIOLATIONS.get(r.code, "true"),
                    "= 0" if r.code in SILVER_VIOLATIONS else "> 0")
        for r in SILVER_RULES
    ]
    rules.append(
        "SELECT 'S18: data loss < 10%', if(s / b > 0.9, 'PASS', 'FAIL'),"
        " concat(CAST(round((1 - s / b) * 100, 2) AS STRING), '% lost')"
        " FROM (SELECT count(*) AS b FROM {raw}) CROSS JOIN (SELECT count(*) AS s FROM {silver})"
    )
    return spark.sql(
        " UNION ALL ".join(rules),
        silver=silver_trips(spark, sf_dir), raw=raw_trips(spark, sf_dir),
    )


def quality_cross_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rule(name: str, gold: str, silver: str, wanted: str) -> str:
        return (
            f"SELECT '{name}' AS test, if(abs(g - s) {wanted}, 'PASS', 'FAIL') AS result,"
            " concat('Gold=', CAST(g AS STRING), ' Silver=', CAST(s AS STRING)) AS details"
            f" FROM ({gold}) CROSS JOIN ({silver})"
        )

    rules = (
        rule("G14: Gold = Silver valid count",
             "SELECT coalesce(sum(trip_count), 0) AS g FROM {trips}",
             "SELECT count(*) AS s FROM {silver} WHERE trip_status = 'valid'", "= 0"),
        rule("G15: Gold = Silver correction count",
             "SELECT coalesce(sum(correction_count), 0) AS g FROM {corrections}",
             "SELECT count(*) AS s FROM {silver} WHERE trip_status = 'correction'", "= 0"),
        rule("G16: Gold revenue = Silver valid revenue",
             "SELECT coalesce(sum(total_revenue), 0) AS g FROM {trips}",
             "SELECT coalesce(sum(total_amount), 0) AS s FROM {silver}"
             " WHERE trip_status = 'valid'", "< 1"),
    )
    gold = gold_tables(spark, sf_dir)
    return spark.sql(
        " UNION ALL ".join(rules),
        silver=silver_trips(spark, sf_dir),
        trips=gold[FACT_TRIPS], corrections=gold[FACT_CORRECTIONS],
    )


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal sums and built-in averages, the date key formatted and parsed per row."""
    statement = f"""
SELECT {_DATE_KEY} AS date_key, payment_type AS payment_key, pickup_location_id,
  dropoff_location_id, pickup_hour, count(*) AS trip_count,
  sum(passenger_count) AS total_passengers, sum(total_amount) AS total_revenue,
  sum(fare_amount) AS total_fare, sum(tip_amount) AS total_tips, sum(tolls_amount) AS total_tolls,
  sum(congestion_surcharge) AS total_congestion, sum(extra_amount) AS total_extra,
  sum(mta_tax) AS total_mta_tax, sum(improvement_surcharge) AS total_improvement,
  sum(airport_fee) AS total_airport_fee, sum(trip_distance_miles) AS total_distance_miles,
  sum(trip_duration_minutes) AS total_duration_minutes,
  CAST(avg(total_amount) AS DECIMAL(38,6)) AS avg_trip_cost,
  CAST(avg(fare_amount) AS DECIMAL(38,6)) AS avg_fare,
  CAST(avg(tip_amount) AS DECIMAL(38,6)) AS avg_tip,
  CAST(avg(trip_distance_miles) AS DECIMAL(38,6)) AS avg_distance_miles,
  CAST(avg(trip_duration_minutes) AS INT) AS avg_duration_minutes,
  CAST(CASE WHEN sum(trip_distance_miles) > 0
       THEN sum(total_amount) / sum(trip_distance_miles) ELSE 0 END AS DECIMAL(38,6))
    AS revenue_per_mile
FROM {{silver}} WHERE trip_status = 'valid' GROUP BY 1, 2, 3, 4, 5"""
    return portable(spark.sql(statement, silver=silver_trips(spark, sf_dir)))


def orphan_payment_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_tables(spark, sf_dir)
    parts = (
        spark.sql(
            f"SELECT '{label}' AS lookup, count(*) AS orphan_rows FROM {{fact}} WHERE payment_key"
            f" NOT IN (SELECT payment_key FROM {{types}} WHERE {condition})",
            fact=gold[FACT_TRIPS], types=gold[DIM_PAYMENT_TYPE],
        )
        for label, condition in (("whole", "true"), ("others", "payment_category = 'Others'"))
    )
    return reduce(DataFrame.unionByName, parts)


def quality_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen statements, each with its own scans."""
    tables = {**gold_tables(spark, sf_dir), "silver": silver_trips(spark, sf_dir)}
    statement = " UNION ALL ".join([*_TABLE_TESTS, *_CROSS_TESTS]).replace("VARCHAR", "STRING")
    named = re.sub(rf"FROM ({'|'.join(tables)})\b", r"FROM {\1}", statement)
    return spark.sql(named, **tables)


def filter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of the raw table for each rule, and one for their conjunction."""
    rules = {**KEEP_RULES, "any": KEEP_ALL}
    earlier, parts = "true", []
    for name, rule in rules.items():
        reached = "true" if name == "any" else earlier
        removed = f"NOT coalesce({rule}, false)"
        parts.append(
            f"SELECT '{name}' AS rule, count_if({removed}) AS removed_alone,"
            f" count_if({removed} AND {reached}) AS removed_in_order,"
            f" count_if({removed}) / CAST(count(*) AS DOUBLE) AS share_alone FROM {{raw}}"
        )
        earlier = f"{earlier} AND coalesce({rule}, false)"
    return spark.sql(" UNION ALL ".join(parts), raw=raw_trips(spark, sf_dir))


def report_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the cleaned trips instead of the fact: month and category of every trip."""
    statement = """
SELECT date_format(pickup_datetime, 'yyyy-MM') AS year_month, p.payment_category,
  count(*) AS trips, sum(passenger_count) AS passengers,
  CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue,
  CAST(sum(tip_amount) AS DECIMAL(38,2)) AS tips,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS revenue_per_trip,
  CAST(sum(tip_amount) AS DOUBLE) / nullif(CAST(sum(total_amount) AS DOUBLE), 0) AS tips_share
FROM {silver} LEFT JOIN {types} p ON payment_type = p.payment_key
WHERE trip_status = 'valid' GROUP BY 1, 2"""
    types = gold_tables(spark, sf_dir)[DIM_PAYMENT_TYPE]
    return spark.sql(statement, silver=silver_trips(spark, sf_dir), types=types)


def build_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed month inferred, read and bound by itself, then united and cleaned."""
    lake = landed_lake(spark, sf_dir)
    types = dict.fromkeys(bronze.CODE_FIELDS, "double")
    months = []
    for path in bronze.Files(spark).matching(lake.trips_glob):
        stored = spark.read.parquet(path)
        months.append(stored.selectExpr(*bronze._bind(stored, types)))
    raw = bronze.merge_airport_fee(reduce(DataFrame.unionByName, months))
    return clean_trips(raw.select(*bronze.TRIP_COLUMNS))


FORMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "build_silver": build_silver,
    "quality_gold": quality_gold,
    "filter_profile": filter_profile,
    "report_overview": report_overview,
    "quality_silver": quality_silver,
    "quality_cross_layer": quality_cross_layer,
    "fact_trips": fact_trips,
    "orphan_payment_trips": orphan_payment_trips,
}
