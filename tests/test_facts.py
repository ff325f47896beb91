from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from farestar.operators.facts import fact_corrections, fact_trips


def test_fact_types(silver_of):
    types = dict(fact_trips(silver_of({})).dtypes)
    assert len(types) == 24
    assert types["date_key"] == types["avg_duration_minutes"] == "int"
    assert types["trip_count"] == types["total_passengers"] == "bigint"
    assert types["total_revenue"] == types["total_distance_miles"] == "decimal(38,2)"
    assert types["avg_fare"] == types["revenue_per_mile"] == "decimal(38,6)"


def test_integer_average_truncates(silver_of):
    pickup = "2023-05-07 10:00:00"
    trips = silver_of(
        {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": "2023-05-07 10:01:00"},
        {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": "2023-05-07 10:02:00"},
    )
    row = fact_trips(trips).first()
    assert (row.trip_count, row.total_duration_minutes, row.avg_duration_minutes) == (2, 3, 1)


def test_null_payment_type_is_a_group(silver_of):
    rows = fact_trips(silver_of({"payment_type": None}, {"payment_type": None}, {})).collect()
    assert {r.payment_key: r.trip_count for r in rows} == {None: 2, 1: 1}


def test_averages_skip_null_amounts(silver_of):
    row = fact_trips(silver_of({"fare_amount": None}, {"fare_amount": 10.0})).first()
    assert (row.trip_count, row.total_fare, row.avg_fare) == (2, Decimal("10.00"), Decimal(10))


def test_all_null_amounts(silver_of):
    row = fact_trips(silver_of({"fare_amount": None, "total_amount": None})).first()
    assert row.total_fare is row.avg_fare is row.total_revenue is row.revenue_per_mile is None


def test_no_distance_means_no_ratio(silver_of):
    row = fact_trips(silver_of({"trip_distance": 0.004})).first()
    assert row.revenue_per_mile == Decimal(0)


def test_status_splits_the_facts(silver_of):
    trips = silver_of({}, {"fare_amount": -4.0, "total_amount": -5.5}, {"total_amount": 1500.0})
    assert fact_trips(trips).first().trip_count == 1
    row = fact_corrections(trips).first()
    assert (row.correction_count, row.total_refunded_fare) == (2, Decimal("11.00"))
    assert row.total_refunded_amount == Decimal("1494.50")
    assert row.avg_refunded_fare == Decimal("5.500000")


def half_up(value: Fraction, digits: int) -> Decimal:
    scaled = abs(value) * 10**digits
    units = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(units if value >= 0 else -units).scaleb(-digits)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-9_999_999_999, 9_999_999_999), min_size=1, max_size=40))
def test_sums_and_averages_are_exact(spark, cents):
    """Any DECIMAL(10,2), up to the widest, against exact fractions."""
    row = (2023, 5, 7, 1, 100)
    amounts = [Decimal(c).scaleb(-2) for c in cents]
    silver = spark.createDataFrame(
        [(*row, "correction", a, a) for a in amounts],
        "trip_year int, trip_month int, trip_day int, payment_type int, pickup_location_id int,"
        " trip_status string, fare_amount decimal(10,2), total_amount decimal(10,2)",
    )
    fact = fact_corrections(silver).first()
    assert fact.total_refunded_fare == sum(amounts)
    assert fact.avg_refunded_fare == half_up(Fraction(sum(cents), 100 * len(cents)), 6)


def test_a_hot_cell_reaches_the_reducer_as_one_row_per_task(spark, silver_of):
    """A third of all rows in one cell: the map side folds them before the shuffle."""
    hot = silver_of({}).crossJoin(spark.range(0, 3000, 1, 4)).drop("id")
    rows = fact_trips(hot).collect()
    assert [r.trip_count for r in rows] == [3000]
    plan = fact_trips(hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")


def test_overflow_raises(spark):
    from farestar.functions.numbers import sum_cents
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    rows = spark.range(1_000_000_000).selectExpr("CAST(99999999.99 AS DECIMAL(10,2)) AS a")
    plan = rows.agg(F.expr(sum_cents("a")))._jdf.queryExecution().analyzed().toString()
    assert "sum(cast(rint" in plan
    with pytest.raises(PySparkException):
        spark.range(3).selectExpr("9000000000000000000L AS c").agg(F.expr("sum(c)")).collect()
