import datetime as dt

import pytest

from farestar.session import build_session

SF_DIR = "/root/testdata/sf0.001"

RAW_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
    " passenger_count string, trip_distance double, RatecodeID string,"
    " store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type string,"
    " fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double,"
    " improvement_surcharge double, total_amount double, congestion_surcharge double,"
    " airport_fee_lower double, airport_fee_upper double, cbd_congestion_fee double"
)
GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2023-05-07 10:00:00",
    "tpep_dropoff_datetime": "2023-05-07 10:15:00",
    "passenger_count": "2.0",
    "trip_distance": 3.5,
    "RatecodeID": "1.0",
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": "1",
    "fare_amount": 15.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 19.0,
    "congestion_surcharge": 2.5,
    "airport_fee_lower": None,
    "airport_fee_upper": None,
    "cbd_congestion_fee": None,
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def raw_of(spark):
    """Raw trips from a good one and the fields each row changes."""
    from farestar.sources.bronze import merge_airport_fee

    def build(*changes):
        rows = []
        for change in changes:
            row = {**GOOD_TRIP, **change}
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
                if isinstance(row[name], str):
                    row[name] = dt.datetime.fromisoformat(row[name])
            rows.append(tuple(row.values()))
        return merge_airport_fee(spark.createDataFrame(rows, RAW_SCHEMA))

    return build


@pytest.fixture(scope="session")
def silver_of(raw_of):
    from farestar.operators.cleaning import clean_trips

    return lambda *changes: clean_trips(raw_of(*changes))
