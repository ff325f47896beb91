"""Edge rows of the cleaning step, each with its expected fate."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

KEPT = {
    "minute boundary": {PICKUP: "2023-05-07 10:00:59", DROPOFF: "2023-05-07 10:01:01"},
    "1440 minutes": {PICKUP: "2023-05-07 10:00:00", DROPOFF: "2023-05-08 10:00:59"},
    "first moment": {PICKUP: "2021-01-01 00:00:00", DROPOFF: "2021-01-01 00:10:00"},
    "last moment": {PICKUP: "2025-12-31 23:59:59", DROPOFF: "2026-01-01 00:10:00"},
    "short distance": {"trip_distance": 0.004},
    "zone 1": {"PULocationID": 1, "DOLocationID": 265},
    "unknown payment": {"payment_type": "7"},
    "NULL payment": {"payment_type": None},
    "NULL amounts": {"fare_amount": None, "total_amount": None},
}
DROPPED = {
    "within a minute": {PICKUP: "2023-05-07 10:00:01", DROPOFF: "2023-05-07 10:00:59"},
    "1441 minutes": {PICKUP: "2023-05-07 10:00:00", DROPOFF: "2023-05-08 10:01:00"},
    "backwards": {PICKUP: "2023-05-07 10:00:00", DROPOFF: "2023-05-07 09:00:00"},
    "broken clock": {PICKUP: "2023-05-07 10:00:00", DROPOFF: "9999-12-31 23:59:59"},
    "too early": {PICKUP: "2020-12-31 23:59:59", DROPOFF: "2021-01-01 00:10:00"},
    "too late": {PICKUP: "2026-01-01 00:00:00", DROPOFF: "2026-01-01 00:10:00"},
    "no distance": {"trip_distance": 0.0},
    "far": {"trip_distance": 500.0},
    "zone 0": {"PULocationID": 0},
    "zone 266": {"DOLocationID": 266},
    "vendor 6": {"VendorID": 6},
    "NULL vendor": {"VendorID": None},
    "NULL distance": {"trip_distance": None},
    "NULL dropoff": {DROPOFF: None},
}


@pytest.fixture(scope="module")
def kept_rows(silver_of):
    # The extra amount names the case, so one job judges all of them.
    cases = list(KEPT.values()) + list(DROPPED.values())
    rows = silver_of(*({**case, "extra": float(i)} for i, case in enumerate(cases))).collect()
    names = list(KEPT) + list(DROPPED)
    return {names[int(row.extra_amount)]: row for row in rows}


def test_exactly_the_possible_rows_are_kept(kept_rows):
    assert set(kept_rows) == set(KEPT)


def test_durations(kept_rows):
    assert kept_rows["minute boundary"].trip_duration_minutes == 1
    assert kept_rows["1440 minutes"].trip_duration_minutes == 1440


def test_distance_is_judged_raw_and_stored_rounded(kept_rows):
    assert kept_rows["short distance"].trip_distance_miles == Decimal("0.00")


def test_payment_codes_survive(kept_rows):
    assert kept_rows["unknown payment"].payment_type == 7
    assert kept_rows["NULL payment"].payment_type is None


def test_calendar_columns(kept_rows):
    row = kept_rows["last moment"]
    assert (row.trip_year, row.trip_month, row.trip_day, row.pickup_hour) == (2025, 12, 31, 23)
    assert row.trip_weekday == "Wednesday"


@pytest.mark.parametrize(
    "fare, total, status",
    [
        (0.004, 5.0, "valid"),
        (10.0, 1000.0, "valid"),
        (10.0, 1000.01, "correction"),
        (0.0, 5.0, "correction"),
        (-3.0, -5.0, "correction"),
        (None, None, "valid"),
        (None, -1.0, "correction"),
        (5.0, None, "valid"),
    ],
)
def test_status(silver_of, fare, total, status):
    row = silver_of({"fare_amount": fare, "total_amount": total}).first()
    assert row.trip_status == status


def test_repaired_columns(silver_of):
    row = silver_of(
        dict.fromkeys(
            ("passenger_count", "RatecodeID", "store_and_fwd_flag", "congestion_surcharge")
        )
    ).first()
    assert (row.passenger_count, row.rate_code_id, row.store_and_fwd_flag) == (1, 1, "N")
    assert row.congestion_surcharge == row.airport_fee == row.cbd_congestion_fee == Decimal("0.00")


@pytest.mark.parametrize("text, code", [("1.9", 1), ("0.0", 0), ("3", 3)])
def test_codes_truncate(silver_of, text, code):
    assert silver_of({"passenger_count": text}).first().passenger_count == code


def test_lower_case_fee_wins(silver_of):
    both = silver_of({"airport_fee_lower": 1.25, "airport_fee_upper": 1.75}).first()
    upper = silver_of({"airport_fee_upper": 1.75}).first()
    assert (both.airport_fee, upper.airport_fee) == (Decimal("1.25"), Decimal("1.75"))


def test_money_rounds_half_up(silver_of):
    assert silver_of({"tip_amount": 2.675}).first().tip_amount == Decimal("2.68")


@pytest.mark.parametrize("change", [{"fare_amount": 1e9}, {"passenger_count": "x1"}])
def test_values_without_a_meaning_raise(silver_of, change):
    with pytest.raises(PySparkException):
        silver_of(change).collect()


def test_schema(silver_of):
    types = dict(silver_of({}).dtypes)
    assert len(types) == 27
    assert types["pickup_datetime"] == "timestamp_ntz"
    assert sum(t == "decimal(10,2)" for t in types.values()) == 11
    assert sum(t == "int" for t in types.values()) == 11
