"""Raw trips -> cleaned trips: drop impossible rows, repair NULLs, type, flag, derive.

One map-only stage: no operator here shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farestar.functions.calendar import minutes_between, weekday_name
from farestar.functions.numbers import blank_as_zero, code, money, money_or_zero

VALID, CORRECTION = "valid", "correction"

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
DURATION = minutes_between(PICKUP, DROPOFF)
CODES = ("passenger_count", "RatecodeID", "payment_type")

# A row is kept when every rule is true; a NULL input drops it.  Cheap comparisons that the
# Parquet scan can use come first, the computed duration last.
KEEP_RULES = {
    "vendor": "VendorID IN (1, 2)",
    "distance": "trip_distance > 0 AND trip_distance < 500",
    "zones": "PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265",
    "date_range": f"{PICKUP} >= TIMESTAMP_NTZ'2021-01-01' AND {PICKUP} < TIMESTAMP_NTZ'2026-01-01'",
    "time_order": f"{DROPOFF} > {PICKUP}",
    # 1 to 1440 minutes as one comparison: a BETWEEN is split into two conjuncts, and each
    # would compute the duration of every row again.
    "duration": f"abs({DURATION} - 720.5D) < 720",
}
KEEP_ALL = " AND ".join(f"({rule})" for rule in KEEP_RULES.values())

# ``correction`` marks refunds, disputes and absurd totals, judged on the raw amounts.  A NULL
# amount decides nothing by itself, so a row of NULL amounts counts as valid.
TRIP_STATUS = (
    "CASE WHEN fare_amount <= 0 OR total_amount <= 0 OR total_amount > 1000"
    f" THEN '{CORRECTION}' ELSE '{VALID}' END"
)

CLEANED_COLUMNS = {
    # Months store ids as INT or BIGINT; the rules above compare what is stored, so that they
    # reach the scan, and the cast follows.
    "vendor_id": "CAST(VendorID AS INT)",
    "pickup_location_id": "CAST(PULocationID AS INT)",
    "dropoff_location_id": "CAST(DOLocationID AS INT)",
    "pickup_datetime": PICKUP,
    "dropoff_datetime": DROPOFF,
    "passenger_count": f"coalesce({code('passenger_count')}, 1)",
    "trip_distance_miles": money("trip_distance"),
    "rate_code_id": f"coalesce({code('RatecodeID')}, 1)",
    "store_and_fwd_flag": "coalesce(store_and_fwd_flag, 'N')",
    "payment_type": code("payment_type"),
    "fare_amount": money("fare_amount"),
    "extra_amount": money("extra"),
    "mta_tax": money("mta_tax"),
    "tip_amount": money("tip_amount"),
    "tolls_amount": money("tolls_amount"),
    "improvement_surcharge": money("improvement_surcharge"),
    "total_amount": money("total_amount"),
    "congestion_surcharge": money_or_zero("congestion_surcharge"),
    "airport_fee": money_or_zero("airport_fee"),
    "cbd_congestion_fee": money_or_zero("cbd_congestion_fee"),
    "trip_duration_minutes": f"CAST({DURATION} AS INT)",
    "trip_year": f"year({PICKUP})",
    "trip_month": f"month({PICKUP})",
    "trip_day": f"day({PICKUP})",
    "trip_weekday": weekday_name(PICKUP),
    "pickup_hour": f"hour({PICKUP})",
    "trip_status": TRIP_STATUS,
}


def clean_trips(raw: DataFrame) -> DataFrame:
    """The silver table: 27 typed columns of the rows that pass every rule.

    Codes may come as numbers or as text; blank text counts as 0, other bad text raises.
    """
    types = dict(raw.dtypes)
    texts = {c: F.expr(blank_as_zero(c)) for c in CODES if types[c] == "string"}
    return raw.withColumns(texts).where(KEEP_ALL).selectExpr(
        *(f"{sql} AS {name}" for name, sql in CLEANED_COLUMNS.items())
    )
