"""The expected result of every query, as SQL for the comparison engine (DuckDB).

Written apart from the Spark operators: common table expressions from the given tables up to
the star schema, and one SELECT per query.  Averages and ratios are computed in exact
integers, because that engine divides decimals as doubles.
"""

from __future__ import annotations

from harness.trips import RAW_SQL

_MONEY = "DECIMAL(10,2)"

_RAW = f"""
fields AS ({RAW_SQL.replace("{ntz}", "").replace("{text}", "VARCHAR").replace("{lineitem}", "lineitem")}),
raw AS (
  SELECT * EXCLUDE (airport_fee_lower, airport_fee_upper),
         coalesce(airport_fee_lower, airport_fee_upper) AS airport_fee
  FROM fields)"""


def _code(name: str) -> str:
    number = f"CASE WHEN trim({name}) = '' THEN '0' ELSE {name} END"
    return f"CAST(trunc(CAST({number} AS DOUBLE)) AS INTEGER)"


_MINUTES = "date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)"
_STATUS = (
    "CASE WHEN fare_amount <= 0 OR total_amount <= 0 OR total_amount > 1000"
    " THEN 'correction' ELSE 'valid' END"
)
_KEEP = {
    "vendor": "VendorID IN (1, 2)",
    "distance": "trip_distance > 0 AND trip_distance < 500",
    "zones": "PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265",
    "date_range": "tpep_pickup_datetime >= TIMESTAMP '2021-01-01'"
    " AND tpep_pickup_datetime < TIMESTAMP '2026-01-01'",
    "time_order": "tpep_dropoff_datetime > tpep_pickup_datetime",
    "duration": f"{_MINUTES} BETWEEN 1 AND 1440",
}
_KEEP_ALL = " AND ".join(f"({rule})" for rule in _KEEP.values())
_DATE_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"

_SILVER_COLUMNS = {
    "vendor_id": "VendorID",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "passenger_count": f"coalesce({_code('passenger_count')}, 1)",
    "trip_distance_miles": f"CAST(trip_distance AS {_MONEY})",
    "rate_code_id": f"coalesce({_code('RatecodeID')}, 1)",
    "store_and_fwd_flag": "coalesce(store_and_fwd_flag, 'N')",
    "payment_type": _code("payment_type"),
    "fare_amount": f"CAST(fare_amount AS {_MONEY})",
    "extra_amount": f"CAST(extra AS {_MONEY})",
    "mta_tax": f"CAST(mta_tax AS {_MONEY})",
    "tip_amount": f"CAST(tip_amount AS {_MONEY})",
    "tolls_amount": f"CAST(tolls_amount AS {_MONEY})",
    "improvement_surcharge": f"CAST(improvement_surcharge AS {_MONEY})",
    "total_amount": f"CAST(total_amount AS {_MONEY})",
    "congestion_surcharge": f"coalesce(CAST(congestion_surcharge AS {_MONEY}), 0)",
    "airport_fee": f"coalesce(CAST(airport_fee AS {_MONEY}), 0)",
    "cbd_congestion_fee": f"coalesce(CAST(cbd_congestion_fee AS {_MONEY}), 0)",
    "trip_duration_minutes": f"CAST({_MINUTES} AS INTEGER)",
    "trip_year": "CAST(year(tpep_pickup_datetime) AS INTEGER)",
    "trip_month": "CAST(month(tpep_pickup_datetime) AS INTEGER)",
    "trip_day": "CAST(day(tpep_pickup_datetime) AS INTEGER)",
    "trip_weekday": "dayname(tpep_pickup_datetime)",
    "pickup_hour": "CAST(hour(tpep_pickup_datetime) AS INTEGER)",
    "trip_status": _STATUS,
}
_SILVER_DECIMALS = (
    "trip_distance_miles", "fare_amount", "extra_amount", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee",
)

_SILVER = f"""{_RAW},
silver AS (
  SELECT {", ".join(f"{sql} AS {name}" for name, sql in _SILVER_COLUMNS.items())}
  FROM raw WHERE {_KEEP_ALL})"""


def _units(name: str) -> str:
    """Summed hundredths of a money column."""
    return f"CAST(sum({name}) * 100 AS HUGEINT)"


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator to six digits, half away from zero, as DECIMAL(38,6)."""
    n, d = f"({numerator})", f"({denominator})"
    units = f"CAST(sign({n}) AS HUGEINT) * ((2 * abs({n}) * 1000000 + {d}) // (2 * {d}))"
    return f"CAST({units} * 0.000001 AS DECIMAL(38,6))"


def _average(name: str) -> str:
    return _half_up(_units(name), f"CAST(count({name}) * 100 AS HUGEINT)")


_TRIP_SUMS = {
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
_TRIP_AVERAGES = {
    "avg_trip_cost": "total_amount",
    "avg_fare": "fare_amount",
    "avg_tip": "tip_amount",
    "avg_distance_miles": "trip_distance_miles",
}

_GOLD = f"""{_SILVER},
fact_trips AS (
  SELECT {_DATE_KEY.format("pickup_datetime")} AS date_key, payment_type AS payment_key,
    pickup_location_id, dropoff_location_id, pickup_hour,
    count(*) AS trip_count,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {", ".join(f"sum({amount}) AS {name}" for name, amount in _TRIP_SUMS.items())},
    CAST(sum(trip_duration_minutes) AS BIGINT) AS total_duration_minutes,
    {", ".join(f"{_average(amount)} AS {name}" for name, amount in _TRIP_AVERAGES.items())},
    CAST(sum(trip_duration_minutes) // count(*) AS INTEGER) AS avg_duration_minutes,
    CASE WHEN sum(trip_distance_miles) > 0
         THEN {_half_up(_units("total_amount"), _units("trip_distance_miles"))}
         ELSE 0 END AS revenue_per_mile
  FROM silver WHERE trip_status = 'valid' GROUP BY 1, 2, 3, 4, 5),
fact_corrections AS (
  SELECT {_DATE_KEY.format("pickup_datetime")} AS date_key, payment_type AS payment_key,
    pickup_location_id, count(*) AS correction_count,
    sum(fare_amount) AS total_refunded_fare, sum(total_amount) AS total_refunded_amount,
    {_average("fare_amount")} AS avg_refunded_fare
  FROM silver WHERE trip_status = 'correction' GROUP BY 1, 2, 3),
dim_payment_type AS (
  SELECT * FROM (VALUES
    (0, 'Unknown', 'Others'), (1, 'Credit Card', 'Credit Card'), (2, 'Cash', 'Cash'),
    (3, 'No Charge', 'Others'), (4, 'Dispute', 'Others'), (5, 'Unknown', 'Others'),
    (6, 'Voided Trip', 'Others')) AS t(payment_key, payment_name, payment_category)),
dim_date AS (
  SELECT {_DATE_KEY.format("full_date")} AS date_key, full_date,
    CAST(year(full_date) AS INTEGER) AS "year", CAST(month(full_date) AS INTEGER) AS "month",
    CAST(day(full_date) AS INTEGER) AS "day", dayname(full_date) AS day_name,
    monthname(full_date) AS month_name, strftime(full_date, '%Y-%m') AS year_month,
    CAST(dayofweek(full_date) + 1 AS INTEGER) AS weekday_num,
    CAST(quarter(full_date) AS INTEGER) AS quarter
  FROM (SELECT CAST(unnest(generate_series(
          (SELECT make_date(min(trip_year), 1, 1) FROM silver),
          (SELECT make_date(max(trip_year), 12, 31) FROM silver),
          INTERVAL 1 DAY)) AS DATE) AS full_date) days)"""

_MONTHS = f"""{_RAW},
present AS (
  SELECT strftime(tpep_pickup_datetime, '%Y') AS "year",
         strftime(tpep_pickup_datetime, '%m') AS "month", count(*) AS trips
  FROM raw GROUP BY 1, 2),
span AS (
  SELECT min(year(tpep_pickup_datetime)) AS low, max(year(tpep_pickup_datetime)) AS high
  FROM raw WHERE {_KEEP["date_range"]}),
grid AS (
  SELECT CAST(y AS VARCHAR) AS "year", lpad(CAST(m AS VARCHAR), 2, '0') AS "month"
  FROM (SELECT unnest(range(low, high + 1)) AS y FROM span) years,
       (SELECT unnest(range(1, 13)) AS m) months)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _exact(sql: str, digits: int = 2) -> str:
    """A decimal as its text, so that engines compare every digit and the scale."""
    return f"CAST(CAST({sql} AS DECIMAL(38,{digits})) AS VARCHAR)"


def _exacts(digits: int, *names: str) -> str:
    return ", ".join(f"{_exact(name, digits)} AS {name}" for name in names)


_FILE_SQL = {
    "month_grid": _with(_MONTHS, 'SELECT "year", "month" FROM grid'),
    "month_paths": _with(
        _MONTHS,
        """SELECT "year", "month", trips,
  'yellow_tripdata_' || "year" || '-' || "month" || '.parquet' AS file_name,
  '/trip-data/yellow_tripdata_' || "year" || '-' || "month" || '.parquet' AS source_path,
  'yellow_tripdata/' || "year" || '/' AS sink_folder
FROM present""",
    ),
    "missing_months": _with(
        _MONTHS,
        """SELECT "year", "month" FROM grid
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p."year" = grid."year" AND p."month" = grid."month")""",
    ),
    "landed_months": _with(_MONTHS, 'SELECT "year", "month" FROM present'),
    # Files of later years store whole numbers, so their text has no fraction.
    "bronze_scan": _with(
        _RAW,
        """SELECT * REPLACE (
    CASE WHEN passenger_count = '' AND year(tpep_pickup_datetime) < 2023 THEN '0.0'
         WHEN passenger_count = '' THEN '0'
         WHEN year(tpep_pickup_datetime) < 2023 THEN passenger_count
         ELSE replace(passenger_count, '.0', '') END AS passenger_count,
    CASE WHEN year(tpep_pickup_datetime) < 2023 THEN RatecodeID
         ELSE replace(RatecodeID, '.0', '') END AS RatecodeID),
  strftime(tpep_pickup_datetime, 'yellow_tripdata_%Y-%m.parquet') AS source_file,
  strftime(tpep_pickup_datetime, '%Y') AS source_year
FROM raw""",
    ),
    "raw_view": _with(
        _RAW,
        """SELECT strftime(tpep_pickup_datetime, 'yellow_tripdata_%Y-%m.parquet') AS source_file,
  count(*) AS trips, count(RatecodeID) AS rated FROM raw GROUP BY 1""",
    ),
    "landed_years": _with(
        _MONTHS,
        """SELECT "year", "month", CASE WHEN EXISTS (
    SELECT 1 FROM present p WHERE p."year" = grid."year" AND p."month" = grid."month")
  THEN 'landed' ELSE 'missing' END AS status FROM grid""",
    ),
    "bronze_airport_fee": _with(
        _RAW,
        """SELECT strftime(tpep_pickup_datetime, '%Y') AS source_year, airport_fee,
  count(*) AS trips FROM raw GROUP BY 1, 2""",
    ),
    "airport_fee_merge": _with(
        _RAW,
        """SELECT tpep_pickup_datetime, airport_fee_lower, airport_fee_upper,
  CASE WHEN airport_fee_lower IS NULL THEN airport_fee_upper ELSE airport_fee_lower END
    AS airport_fee
FROM fields""",
    ),
}


def _silver_sql() -> dict[str, str]:
    amounts = (
        "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
        "cbd_congestion_fee",
    )
    codes = ("passenger_count", "RatecodeID", "payment_type")
    repaired = {
        "passenger_count": "passenger_count", "rate_code_id": "RatecodeID",
        "store_and_fwd_flag": "store_and_fwd_flag",
        "congestion_surcharge": "congestion_surcharge", "airport_fee": "airport_fee",
        "cbd_congestion_fee": "cbd_congestion_fee",
    }
    calendar = ("trip_year", "trip_month", "trip_day", "trip_weekday", "pickup_hour")

    def new(name: str) -> str:
        sql = _SILVER_COLUMNS[name]
        return _exact(sql) if name in _SILVER_DECIMALS else sql

    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    inputs = {
        "vendor": "VendorID", "distance": "trip_distance",
        "zones": "PULocationID, DOLocationID", "date_range": pickup,
        "time_order": f"{pickup}, {dropoff}", "duration": f"{pickup}, {dropoff}",
    }
    selects = {
        "silver_money": ", ".join(amounts) + ", " + ", ".join(
            f"{_exact(f'CAST({a} AS {_MONEY})')} AS new_{a}" for a in amounts
        ),
        "silver_codes": ", ".join(codes) + ", " + ", ".join(
            f"{_code(c)} AS new_{c}" for c in codes
        ),
        "silver_null_fix": ", ".join(repaired.values()) + ", " + ", ".join(
            f"{new(name)} AS new_{name}" for name in repaired
        ),
        "silver_duration": f"{pickup}, {dropoff}, {_MINUTES} AS trip_duration_minutes",
        "silver_calendar": f"{pickup}, " + ", ".join(f"{new(c)} AS new_{c}" for c in calendar),
        "silver_trip_status": f"fare_amount, total_amount, {_STATUS} AS trip_status",
        "date_key": f"{pickup}, {_DATE_KEY.format(pickup)} AS date_key",
    }
    statements = {name: _with(_RAW, f"SELECT {s} FROM raw") for name, s in selects.items()}
    for rule, columns in inputs.items():
        statements[f"filter_{rule}"] = _with(
            _RAW, f"SELECT {columns} FROM raw WHERE {_KEEP[rule]}"
        )
    whole = ", ".join(
        f"{_exact(name)} AS {name}" if name in _SILVER_DECIMALS else name
        for name in _SILVER_COLUMNS
    )
    statements["silver_trips"] = _with(_SILVER, f"SELECT {whole} FROM silver")
    return statements


def _profile_sql() -> dict[str, str]:
    names = list(_KEEP)
    parts = []
    for position, name in enumerate(names):
        earlier = " AND ".join(f"coalesce({_KEEP[n]}, false)" for n in names[:position]) or "true"
        parts.append(
            f"SELECT '{name}' AS rule, NOT coalesce({_KEEP[name]}, false) AS alone,"
            f" {earlier} AS reached FROM raw"
        )
    parts.append(
        f"SELECT 'any' AS rule, NOT coalesce({_KEEP_ALL}, false) AS alone, true AS reached FROM raw"
    )
    repaired = (
        "passenger_count", "RatecodeID", "store_and_fwd_flag",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    )
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} IS NULL AS is_null FROM raw" for c in repaired
    )
    return {
        "filter_profile": _with(
            _RAW,
            f"""SELECT rule, count(*) FILTER (alone) AS removed_alone,
  count(*) FILTER (alone AND reached) AS removed_in_order,
  CAST(count(*) FILTER (alone) AS DOUBLE) / count(*) AS share_alone
FROM ({" UNION ALL ".join(parts)}) judged GROUP BY rule""",
        ),
        "null_profile": _with(
            _RAW,
            f"""SELECT column_name, count(*) FILTER (is_null) AS null_rows,
  CAST(count(*) FILTER (is_null) AS DOUBLE) / count(*) AS null_share
FROM ({nulls}) cells GROUP BY column_name""",
        ),
        "status_profile": _with(
            _SILVER,
            """SELECT trip_status, trips,
  CAST(trips AS DOUBLE) / (SELECT count(*) FROM raw) AS share
FROM (SELECT 'valid' AS trip_status, count(*) AS trips FROM silver WHERE trip_status = 'valid'
      UNION ALL
      SELECT 'correction', count(*) FROM silver WHERE trip_status = 'correction'
      UNION ALL
      SELECT 'removed', (SELECT count(*) FROM raw) - (SELECT count(*) FROM silver)) counted""",
        ),
    }


_TRIP_MEASURES = (
    "date_key, payment_key, pickup_location_id, dropoff_location_id, pickup_hour, trip_count,"
    " total_passengers, total_duration_minutes, avg_duration_minutes, "
    + _exacts(2, *_TRIP_SUMS) + ", " + _exacts(6, *_TRIP_AVERAGES, "revenue_per_mile")
)

_GOLD_SQL = {
    "dim_date": "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date",
    "dim_payment_type": """SELECT payment_key, payment_name, payment_category,
  (SELECT count(*) FROM silver WHERE payment_type = payment_key) AS trips
FROM dim_payment_type""",
    "fact_trips": f"SELECT {_TRIP_MEASURES} FROM fact_trips",
    "fact_corrections": f"""SELECT date_key, payment_key, pickup_location_id, correction_count,
  {_exacts(2, "total_refunded_fare", "total_refunded_amount")}, {_exacts(6, "avg_refunded_fare")}
FROM fact_corrections""",
    "star_trips": """SELECT f.date_key, CAST(d.full_date AS VARCHAR) AS full_date, d.day_name,
  d.year_month, d.quarter, f.payment_key, p.payment_name, p.payment_category,
  f.pickup_location_id, f.dropoff_location_id, f.pickup_hour, f.trip_count,
  CAST(CAST(f.total_revenue AS DECIMAL(38,2)) AS VARCHAR) AS total_revenue
FROM fact_trips f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_payment_type p ON f.payment_key = p.payment_key""",
    "star_corrections": """SELECT f.date_key, CAST(d.full_date AS VARCHAR) AS full_date,
  d.month_name, d.year_month, d.weekday_num, f.payment_key, p.payment_name,
  p.payment_category, f.pickup_location_id, f.correction_count,
  CAST(CAST(f.total_refunded_amount AS DECIMAL(38,2)) AS VARCHAR) AS total_refunded_amount
FROM fact_corrections f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_payment_type p ON f.payment_key = p.payment_key""",
    "dim_date_key_unique": """SELECT CAST(sum(n) AS BIGINT) AS days,
  CAST(sum(outside) AS BIGINT) AS days_outside, max(n) AS most_rows_of_a_key
FROM (SELECT date_key, count(*) AS n,
        count(*) FILTER (full_date < DATE '2021-01-01' OR full_date >= DATE '2026-01-01')
          AS outside
      FROM dim_date GROUP BY date_key) keys""",
    **{
        f"orphan_payment_{kind}": f"""SELECT 'whole' AS lookup, count(*) AS orphan_rows
FROM fact_{kind} WHERE payment_key NOT IN (SELECT payment_key FROM dim_payment_type)
UNION ALL
SELECT 'others', count(*) FROM fact_{kind} WHERE payment_key NOT IN
  (SELECT payment_key FROM dim_payment_type WHERE payment_category = 'Others')"""
        for kind in ("trips", "corrections")
    },
    **{
        f"orphan_keys_{kind}": f"""SELECT payment_key, count(*) AS fact_rows
FROM fact_{kind} WHERE payment_key NOT IN
  (SELECT payment_key FROM dim_payment_type WHERE payment_category = 'Others')
GROUP BY payment_key"""
        for kind in ("trips", "corrections")
    },
    "report_overview": """SELECT year_month, payment_category,
  CAST(sum(trip_count) AS BIGINT) AS trips,
  CAST(sum(total_passengers) AS BIGINT) AS passengers,
  CAST(CAST(sum(total_revenue) AS DECIMAL(38,2)) AS VARCHAR) AS revenue, CAST(CAST(sum(total_tips) AS DECIMAL(38,2)) AS VARCHAR) AS tips,
  CAST(sum(total_revenue) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS revenue_per_trip,
  CAST(sum(total_tips) AS DOUBLE) / CAST(sum(total_revenue) AS DOUBLE) AS tips_share
FROM fact_trips f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_payment_type p ON f.payment_key = p.payment_key
GROUP BY year_month, payment_category""",
    "report_revenue": f"""SELECT "year", quarter, payment_name,
  CAST(sum(trip_count) AS BIGINT) AS trips,
  {", ".join(f"{_exact(f'sum({n})')} AS {n}" for n in list(_TRIP_SUMS)[:9])}
FROM fact_trips f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_payment_type p ON f.payment_key = p.payment_key
GROUP BY "year", quarter, payment_name""",
    "report_zones": """SELECT pickup_location_id, CAST(sum(trip_count) AS BIGINT) AS trips,
  CAST(CAST(sum(total_revenue) AS DECIMAL(38,2)) AS VARCHAR) AS revenue,
  CAST(CAST(sum(total_distance_miles) AS DECIMAL(38,2)) AS VARCHAR) AS miles,
  CAST(sum(total_revenue) AS DOUBLE) / CAST(sum(total_distance_miles) AS DOUBLE)
    AS revenue_per_mile
FROM fact_trips GROUP BY pickup_location_id""",
    "report_temporal": """SELECT weekday_num, day_name, pickup_hour,
  CAST(sum(trip_count) AS BIGINT) AS trips, CAST(CAST(sum(total_revenue) AS DECIMAL(38,2)) AS VARCHAR) AS revenue
FROM fact_trips f LEFT JOIN dim_date d ON f.date_key = d.date_key
GROUP BY weekday_num, day_name, pickup_hour""",
    "report_corrections": """SELECT year_month, payment_name,
  CAST(sum(correction_count) AS BIGINT) AS corrections,
  CAST(CAST(sum(total_refunded_fare) AS DECIMAL(38,2)) AS VARCHAR) AS refunded_fare,
  CAST(CAST(sum(total_refunded_amount) AS DECIMAL(38,2)) AS VARCHAR) AS refunded_amount
FROM fact_corrections f LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_payment_type p ON f.payment_key = p.payment_key
GROUP BY year_month, payment_name""",
}


def _count_test(name: str, table: str, condition: str = "true", wanted: str = "= 0") -> str:
    return f"""SELECT '{name}' AS test,
  CASE WHEN count(*) {wanted} THEN 'PASS' ELSE 'FAIL' END AS result,
  CAST(count(*) AS VARCHAR) AS details
FROM {table} WHERE {condition}"""


def _pair_test(name: str, gold: str, silver: str, wanted: str = "= 0") -> str:
    return f"""SELECT '{name}' AS test,
  CASE WHEN abs(g - s) {wanted} THEN 'PASS' ELSE 'FAIL' END AS result,
  'Gold=' || CAST(g AS VARCHAR) || ' Silver=' || CAST(s AS VARCHAR) AS details
FROM (SELECT ({gold}) AS g, ({silver}) AS s) pair"""


_SILVER_TESTS = [
    _count_test("S01: Silver not empty", "silver", wanted="> 0"),
    _count_test("S02: vendor_id in {1,2}", "silver", "vendor_id NOT IN (1, 2)"),
    _count_test("S03: pickup < dropoff", "silver", "pickup_datetime >= dropoff_datetime"),
    _count_test("S04: duration 1-1440 min", "silver",
                "trip_duration_minutes > 1440 OR trip_duration_minutes < 1"),
    _count_test("S05: passenger_count >= 0", "silver", "passenger_count < 0"),
    _count_test("S06: trip_distance > 0", "silver", "trip_distance_miles <= 0"),
    _count_test("S07: store_and_fwd Y/N", "silver", "store_and_fwd_flag NOT IN ('Y', 'N')"),
    _count_test("S08: PU location 1-265", "silver",
                "pickup_location_id < 1 OR pickup_location_id > 265"),
    _count_test("S09: DO location 1-265", "silver",
                "dropoff_location_id < 1 OR dropoff_location_id > 265"),
    _count_test("S10: payment_type 0-6", "silver", "payment_type < 0 OR payment_type > 6"),
    _count_test("S11: trip_status valid/correction", "silver",
                "trip_status <> 'valid' AND trip_status <> 'correction'"),
    _count_test("S12: valid fare > 0", "silver", "trip_status = 'valid' AND fare_amount <= 0"),
    _count_test("S13: valid total > 0", "silver", "trip_status = 'valid' AND total_amount <= 0"),
    _count_test("S14: corrections negative", "silver",
                "trip_status = 'correction' AND fare_amount > 0 AND total_amount > 0"),
    _count_test("S15: no NULLs in fixed cols", "silver",
                "passenger_count IS NULL OR rate_code_id IS NULL OR store_and_fwd_flag IS NULL"
                " OR congestion_surcharge IS NULL OR airport_fee IS NULL"
                " OR cbd_congestion_fee IS NULL"),
    _count_test("S16: dates in 2021-2025", "silver",
                "year(pickup_datetime) < 2021 OR year(pickup_datetime) > 2025"),
    _count_test("S17: derived cols not NULL", "silver",
                "trip_year IS NULL OR trip_month IS NULL OR trip_day IS NULL"
                " OR trip_weekday IS NULL OR pickup_hour IS NULL"
                " OR trip_duration_minutes IS NULL"),
]
_LOSS_TEST = """SELECT 'S18: data loss < 10%' AS test,
  CASE WHEN s > 0.9 * b THEN 'PASS' ELSE 'FAIL' END AS result,
  regexp_replace(CAST(round((1 - CAST(s AS DOUBLE) / b) * 100, 2) AS VARCHAR), '\\.0$', '')
    || '% lost' AS details
FROM (SELECT (SELECT count(*) FROM silver) AS s, (SELECT count(*) FROM raw) AS b) counts"""
_TABLE_TESTS = [
    _count_test("G01: dim_date not empty", "dim_date", wanted="> 0"),
    _count_test("G02: dates 2021-2025", "dim_date",
                "full_date < DATE '2021-01-01' OR full_date >= DATE '2026-01-01'"),
    """SELECT 'G03: no duplicate date_key' AS test,
  CASE WHEN max(n) = 1 THEN 'PASS' ELSE 'FAIL' END AS result, CAST(max(n) AS VARCHAR) AS details
FROM (SELECT count(*) AS n FROM dim_date GROUP BY date_key) keys""",
    _count_test("G04: dim_payment_type count = 7", "dim_payment_type", wanted="= 7"),
    _count_test("G05: payment_category mapped", "dim_payment_type",
                "payment_category NOT IN ('Credit Card', 'Cash', 'Others')"),
    _count_test("G06: fact_trips not empty", "fact_trips", wanted="> 0"),
    _count_test("G07: total_revenue >= 0", "fact_trips", "total_revenue < 0"),
    _count_test("G08: trip_count > 0", "fact_trips", "trip_count <= 0"),
    _count_test("G09: avg_trip_cost <= 1000", "fact_trips",
                "avg_trip_cost <= 0 OR avg_trip_cost > 1000"),
    _count_test("G10: valid payment types", "fact_trips",
                "payment_key NOT IN (SELECT payment_key FROM dim_payment_type)"),
    _count_test("G11: fact_corrections not empty", "fact_corrections", wanted="> 0"),
    _count_test("G12: correction_count is positive", "fact_corrections", "correction_count <= 0"),
    _count_test("G13: valid payment types (corrections)", "fact_corrections",
                "payment_key NOT IN (SELECT payment_key FROM dim_payment_type)"),
]
_CROSS_TESTS = [
    _pair_test("G14: Gold = Silver valid count",
               "SELECT CAST(coalesce(sum(trip_count), 0) AS BIGINT) FROM fact_trips",
               "SELECT count(*) FROM silver WHERE trip_status = 'valid'"),
    _pair_test("G15: Gold = Silver correction count",
               "SELECT CAST(coalesce(sum(correction_count), 0) AS BIGINT) FROM fact_corrections",
               "SELECT count(*) FROM silver WHERE trip_status = 'correction'"),
    _pair_test("G16: Gold revenue = Silver valid revenue",
               "SELECT CAST(coalesce(sum(total_revenue), 0) AS DECIMAL(38,2)) FROM fact_trips",
               "SELECT CAST(coalesce(sum(total_amount), 0) AS DECIMAL(38,2)) FROM silver"
               " WHERE trip_status = 'valid'", "< 1"),
]


def _all_of(tests: list[str]) -> str:
    return "\nUNION ALL\n".join(tests)


def all_sql() -> dict[str, str]:
    return {
        **_FILE_SQL,
        **_silver_sql(),
        **_profile_sql(),
        **{name: _with(_GOLD, select) for name, select in _GOLD_SQL.items()},
        "quality_silver": _with(_SILVER, _all_of([*_SILVER_TESTS, _LOSS_TEST])),
        "quality_data_loss": _with(_SILVER, _LOSS_TEST),
        "quality_gold": _with(_GOLD, _all_of([*_TABLE_TESTS, *_CROSS_TESTS])),
        "quality_cross_layer": _with(_GOLD, _all_of(_CROSS_TESTS)),
    }
