"""Trip-shaped rows derived from ``lineitem``, row by row, with the dirt real trips have.

One text serves both engines: ``{ntz}`` is the zone-less timestamp prefix and ``{text}`` the
string type.  Amounts carry two decimals, so both engines round them alike.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farestar.functions.calendar import year_month
from farestar.functions.numbers import blank_as_zero
from farestar.lake import Lake
from farestar.operators.cleaning import CODES, KEEP_RULES, PICKUP, clean_trips
from farestar.plans.medallion import build_gold
from farestar.session import scratch_folder
from farestar.sources.bronze import merge_airport_fee
from farestar.sources.landing import land_months, land_years
from farestar.sources.months import months_of
from farestar.sources.tables import create_table_as

RAW_SQL = """
SELECT vid AS VendorID,
  pu AS tpep_pickup_datetime,
  pu + dur_s * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
  CASE WHEN k % 4 = 0 THEN NULL WHEN k % 97 = 11 THEN ''
       ELSE concat(CAST(k % 7 AS {text}), '.0') END AS passenger_count,
  CASE WHEN k % 80 = 3 THEN 0.0e0 WHEN k % 499 = 2 THEN 600.0e0
       ELSE l_quantity * 0.5e0 END AS trip_distance,
  CASE WHEN k % 4 = 0 THEN NULL ELSE concat(CAST(1 + k % 6 AS {text}), '.0') END AS RatecodeID,
  CASE WHEN k % 4 = 0 THEN NULL WHEN k % 50 = 1 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CASE WHEN k % 1009 = 5 THEN 266 ELSE CAST(1 + (l_suppkey % 4) * 66 AS INT) END AS PULocationID,
  CASE WHEN k % 1009 = 6 THEN 0 ELSE CAST(1 + (l_partkey % 2) * 264 AS INT) END AS DOLocationID,
  CASE WHEN k % 211 = 0 THEN NULL ELSE CAST(k % 6 AS {text}) END AS payment_type,
  fare AS fare_amount,
  (k % 3) * 0.5e0 AS extra,
  0.5e0 AS mta_tax,
  FLOOR(l_discount * 1000) / 100 AS tip_amount,
  CASE WHEN k % 15 = 0 THEN 6.55e0 ELSE 0.0e0 END AS tolls_amount,
  1.0e0 AS improvement_surcharge,
  CASE WHEN fare < 0 THEN fare - 1.5e0 ELSE fare + 1.5e0 END AS total_amount,
  CASE WHEN k % 4 = 0 THEN NULL ELSE 2.5e0 END AS congestion_surcharge,
  CASE WHEN pu < TIMESTAMP{ntz} '2023-01-01 00:00:00' AND k % 10 = 3 THEN 1.25e0
       ELSE NULL END AS airport_fee_lower,
  CASE WHEN pu >= TIMESTAMP{ntz} '2023-01-01 00:00:00' AND k % 10 = 3 THEN 1.75e0
       ELSE NULL END AS airport_fee_upper,
  CASE WHEN pu >= TIMESTAMP{ntz} '2025-01-01 00:00:00' THEN 0.75e0
       ELSE NULL END AS cbd_congestion_fee
FROM (
  SELECT *,
    CASE WHEN k % 997 = 0 THEN TIMESTAMP{ntz} '2020-12-31 12:00:00'
         WHEN k % 997 = 1 THEN TIMESTAMP{ntz} '2026-01-01 00:00:00'
         ELSE TIMESTAMP{ntz} '2021-01-01 00:00:00'
              + CAST(((l_orderkey % 61) * 30 * 86400 + (l_linenumber * 3) * 3600
                      + (k * 31) % 3600) AS INT) * INTERVAL '1' SECOND END AS pu,
    CASE WHEN k % 130 = 0 THEN 6 WHEN k % 130 = 1 THEN 7
         ELSE CAST(1 + k % 2 AS INT) END AS vid,
    CASE WHEN k % 100 = 7 THEN 20 WHEN k % 130 = 1 THEN -600 WHEN k % 499 = 3 THEN 90000
         ELSE CAST(60 + (k * 37) % 5400 AS INT) END AS dur_s,
    CASE WHEN k % 613 = 0 THEN 1500.0e0
         WHEN k % 12 = 5 THEN -(FLOOR(l_extendedprice / 10) / 100)
         WHEN k % 701 = 0 THEN 0.0e0
         ELSE FLOOR(l_extendedprice / 10) / 100 END AS fare
  FROM (SELECT *, l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber AS k
        FROM {lineitem}) keyed
) timed
"""


def derive_raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = RAW_SQL.replace("{ntz}", "_NTZ").replace("{text}", "STRING")
    return spark.sql(text, lineitem=lineitem)


_STAGED: dict[tuple[str, str, str], object] = {}
# Stages build on earlier ones, so the thread that builds one may ask for another.
_STAGING = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, stage: str, build: Callable[[], object]):
    """Result of ``build``, run once in an application for each table folder.

    Later layers read the written Parquet of earlier ones, as they do in production, so their
    plans prune columns and push filters, and no query repeats the derivation.  Threads that ask
    for the same stage wait for the one that builds it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    with _STAGING:
        if key not in _STAGED:
            _STAGED[key] = build()
        return _STAGED[key]


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    return _once(spark, sf_dir, "lake", lambda: Lake(scratch_folder(spark, "lake")))


def raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 declared raw fields, the two cased airport fees still apart."""
    path = f"{lake_of(spark, sf_dir).root}/raw"
    return _once(
        spark, sf_dir, "raw", lambda: create_table_as(derive_raw_fields(spark, sf_dir), path)
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_airport_fee(raw_fields(spark, sf_dir))


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table, written and read back."""
    raw = raw_trips(spark, sf_dir)
    path = lake_of(spark, sf_dir).silver_trips
    return _once(spark, sf_dir, "silver", lambda: create_table_as(clean_trips(raw), path))


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four star-schema tables, written and read back."""
    silver_trips(spark, sf_dir)
    lake = lake_of(spark, sf_dir)
    return _once(spark, sf_dir, "gold", lambda: build_gold(spark, lake))


# (first year, last year, names and types as published in those years)
_OLD = {"VendorID": "bigint", "passenger_count": "double", "RatecodeID": "double",
        "payment_type": "bigint"}
_NEW = {**_OLD, "passenger_count": "bigint", "RatecodeID": "bigint"}
_ERAS = (
    (0, 2022, _OLD, {"airport_fee_lower": "airport_fee"}),
    (2023, 2024, _NEW, {"airport_fee_upper": "Airport_fee"}),
    (2025, 9999, {**_NEW, "VendorID": "int"},
     {"airport_fee_upper": "Airport_fee", "cbd_congestion_fee": "cbd_congestion_fee"}),
)
_OPTIONAL = ("airport_fee_lower", "airport_fee_upper", "cbd_congestion_fee")


def _publish(raw: DataFrame, folder: str) -> None:
    """Writes the raw rows month by month, with the column drift of three eras.

    The rebalance hint gathers a month into few files and lets adaptive execution split a
    month that is far larger than the others.
    """
    for first, last, types, optional in _ERAS:
        columns = [
            f"CAST(CAST({blank_as_zero(name) if name in CODES else name} AS DOUBLE)"
            f" AS {types[name]}) AS {name}" if name in types else name
            for name in raw.columns if name not in _OPTIONAL
        ]
        columns += [f"{name} AS {stored}" for name, stored in optional.items()]
        (
            raw.where(f"year({PICKUP}) BETWEEN {first} AND {last}")
            .selectExpr(*columns, f"{year_month(PICKUP)} AS published")
            .hint("rebalance", "published")
            .write.mode("append")
            .partitionBy("published")
            .parquet(folder)
        )


def _published(spark: SparkSession, sf_dir: str) -> str:
    """The folder that holds the raw rows month by month, as a source would publish them."""

    def publish() -> str:
        folder = f"{lake_of(spark, sf_dir).root}/published"
        _publish(raw_fields(spark, sf_dir), folder)
        return folder

    return _once(spark, sf_dir, "published", publish)


def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of whole years landed in a lake of their own: (year, month, status, path)."""

    def land() -> DataFrame:
        published = _published(spark, sf_dir)
        years = raw_trips(spark, sf_dir).where(KEEP_RULES["date_range"]).selectExpr(
            f"min(year({PICKUP})) AS low", f"max(year({PICKUP})) AS high"
        ).first()
        return land_years(
            spark, years.low, years.high, lambda y, m: f"{published}/published={y}-{m}",
            Lake(f"{lake_of(spark, sf_dir).root}/years"),
        )

    return _once(spark, sf_dir, "landing_report", land)


def landed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose bronze layer holds the derived trips, landed month by month."""

    def land() -> Lake:
        lake = lake_of(spark, sf_dir)
        published = _published(spark, sf_dir)
        raw = raw_fields(spark, sf_dir)
        land_months(
            spark,
            sorted((row.year, row.month) for row in months_of(raw, PICKUP).collect()),
            lambda year, month: f"{published}/published={year}-{month}",
            lake,
        )
        return lake

    return _once(spark, sf_dir, "landed", land)
