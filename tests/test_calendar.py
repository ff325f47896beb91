import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from farestar.functions import calendar
from farestar.operators.dimensions import date_bounds, dim_date


def minutes(spark, pairs):
    parsed = [tuple(dt.datetime.fromisoformat(t) for t in pair) for pair in pairs]
    df = spark.createDataFrame(parsed, "a timestamp_ntz, b timestamp_ntz")
    return [r[0] for r in df.selectExpr(calendar.minutes_between("a", "b")).collect()]


BOUNDARIES = [
    (("2021-01-01 10:00:59", "2021-01-01 10:01:01"), 1),
    (("2021-01-01 10:00:01", "2021-01-01 10:00:59"), 0),
    (("2021-01-01 10:00:59.600000", "2021-01-01 10:01:00.200000"), 1),
    (("2021-01-01 10:02:00", "2021-01-01 10:01:59.999999"), -1),
    (("2021-03-14 01:00:59", "2021-03-14 03:01:01"), 121),
    (("1900-01-01 10:00:59", "9999-01-01 10:01:01"), 4259662561),
]


def test_minute_boundaries(spark):
    assert minutes(spark, [pair for pair, _ in BOUNDARIES]) == [n for _, n in BOUNDARIES]


def test_minutes_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert minutes(spark, [pair for pair, _ in BOUNDARIES]) == [n for _, n in BOUNDARIES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@settings(max_examples=4, deadline=None)
@given(
    st.lists(
        st.tuples(*(st.datetimes(dt.datetime(1950, 1, 1), dt.datetime(2100, 1, 1)) for _ in "ab")),
        min_size=50, max_size=50,
    )
)
def test_minutes_equal_the_difference_of_truncated_times(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.selectExpr(calendar.minutes_between("a", "b")).collect()]
    whole = [[t.replace(second=0, microsecond=0) for t in pair] for pair in pairs]
    assert got == [int((b - a).total_seconds()) // 60 for a, b in whole]


def test_published_calendar(spark):
    days = dim_date(date_bounds(spark)).orderBy("date_key").collect()
    assert len(days) == 1826
    first = days[0].asDict()
    assert first == {
        "date_key": 20210101, "full_date": dt.date(2021, 1, 1), "year": 2021, "month": 1,
        "day": 1, "day_name": "Friday", "month_name": "January", "year_month": "2021-01",
        "weekday_num": 6, "quarter": 1,
    }
    for row in days:
        day = row.full_date
        assert row.date_key == int(day.strftime("%Y%m%d"))
        assert row.day_name == day.strftime("%A") and row.month_name == day.strftime("%B")
        assert row.weekday_num == day.isoweekday() % 7 + 1
        assert row.year_month == day.strftime("%Y-%m")
        assert row.quarter == (day.month + 2) // 3


@pytest.mark.parametrize("name", ["date_key", "year", "weekday_num", "quarter"])
def test_calendar_numbers_are_ints(spark, name):
    assert dim_date(date_bounds(spark)).schema[name].dataType.simpleString() == "int"
