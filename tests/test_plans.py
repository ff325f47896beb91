"""The plans that large tables rely on."""

import re

import pytest

from harness import registry
from harness.trips import raw_trips, silver_trips


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    return sum("FileScan" in line and table in line for line in text.splitlines())


@pytest.fixture(scope="module")
def plan_of(spark, sf_dir):
    return lambda name: plan(registry.all_queries()[name](spark, sf_dir))


def test_cleaning_does_not_shuffle(plan_of):
    text = plan_of("silver_trips")
    assert "Exchange" not in text and "Python" not in text


def test_cleaning_filters_reach_the_scan(spark, sf_dir):
    df = registry.cleaned_trips(spark, sf_dir)
    node = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    pushed = node.metadata().apply("PushedFilters")
    for wanted in ("In(VendorID, [1,2])", "LessThan(trip_distance,500.0)",
                   "GreaterThanOrEqual(PULocationID,1)"):
        assert wanted in pushed


@pytest.mark.parametrize("zone_type", ["INT", "BIGINT"])
def test_id_rules_reach_the_scan_of_landed_months(spark, sf_dir, tmp_path, zone_type):
    from farestar.lake import Lake
    from farestar.operators.cleaning import clean_trips
    from farestar.sources.bronze import read_bronze_trips
    from harness.trips import landed_lake

    lake = landed_lake(spark, sf_dir)
    if zone_type == "BIGINT":
        wide = Lake(str(tmp_path / "wide"))
        for year, types in (("2021", "BIGINT"), ("2025", "INT")):
            month = spark.read.parquet(lake.month_path(year, "01"))
            zones = {c: month[c].cast("bigint") for c in ("PULocationID", "DOLocationID")}
            zones["VendorID"] = month["VendorID"].cast(types)
            month.withColumns(zones).write.parquet(wide.month_path(year, "01"))
        lake = wide
    leaves = clean_trips(read_bronze_trips(spark, lake))._jdf.queryExecution().executedPlan().collectLeaves()
    groups = [leaves.apply(i).metadata().apply("PushedFilters") for i in range(leaves.size())]
    assert len(groups) > 1
    for pushed in groups:
        for wanted in ("In(VendorID, [1,2])", "LessThan(trip_distance,500.0)",
                       "GreaterThanOrEqual(PULocationID,1)", "LessThanOrEqual(DOLocationID,265)"):
            assert wanted in pushed


def test_orphans_scan_the_fact_once(plan_of):
    text = plan_of("orphan_payment_trips")
    # The fact once, the dimension for its size and for the join.
    assert text.count("FileScan") == 3


def test_duration_is_computed_once_by_the_filter(spark, sf_dir):
    condition = next(
        line for line in plan(registry.cleaned_trips(spark, sf_dir)).splitlines() if "Filter (" in line
    )
    assert condition.count("interval second") == 1


@pytest.mark.parametrize("name", ["fact_trips", "fact_corrections"])
def test_a_fact_shuffles_once_and_reads_only_its_columns(plan_of, name):
    text = plan_of(name)
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "EqualTo(trip_status," in text
    assert "pickup_datetime" not in text


def test_silver_suite_skips_clean_row_groups(spark, sf_dir, plan_of):
    text = plan_of("quality_silver")
    assert "Join" not in text and "CartesianProduct" not in text
    # Two scans of the cleaned table: six columns of all rows, and the out-of-range filter.
    assert scans(text, "fare_amount") == 1 and scans(text, "rate_code_id") == 1
    report = registry.quality_silver(spark, sf_dir)
    leaves = report._jdf.queryExecution().sparkPlan().collectLeaves()
    pushed = [leaves.apply(i).metadata().apply("PushedFilters") for i in range(leaves.size())]
    suspect = next(p for p in pushed if "rate_code_id" in p)
    assert suspect.startswith("[Or(") and "IsNull(trip_year)" in suspect


def test_clean_row_groups_are_not_read(spark, tmp_path):
    from farestar.operators import quality

    path = str(tmp_path / "silver")
    silver = registry.cleaned_trips(spark, "/root/testdata/sf0.001")
    silver.coalesce(1).write.parquet(path)
    out_of_range = " OR ".join(f"({t})" for t in quality.RANGE_VIOLATIONS.values())
    suspects = spark.read.parquet(path).where(out_of_range)
    suspects.collect()
    scan = suspects._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() == 0


def test_gold_suite_reads_each_fact_once(plan_of):
    text = plan_of("quality_gold")
    assert scans(text, "avg_trip_cost") == 1 and scans(text, "correction_count") == 1
    assert scans(text, "total_amount") == 1
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["star_trips", "report_overview", "report_revenue"])
def test_dimensions_are_broadcast_by_their_size(spark, plan_of, name):
    assert plan_of(name).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_shuffle_partial_sums_only(plan_of):
    text = plan_of("report_temporal")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_rows_are_either_kept_or_dropped_by_a_first_rule(spark, sf_dir):
    raw, silver = raw_trips(spark, sf_dir), silver_trips(spark, sf_dir)
    profile = registry.all_queries()["filter_profile"](spark, sf_dir).collect()
    in_order = sum(r.removed_in_order for r in profile if r.rule != "any")
    any_rule = next(r.removed_alone for r in profile if r.rule == "any")
    assert in_order == any_rule == raw.count() - silver.count()


def test_the_facts_cover_the_cleaned_table(spark, sf_dir):
    trips = registry.fact_trips(spark, sf_dir).agg({"trip_count": "sum"}).first()[0]
    corrections = registry.fact_corrections(spark, sf_dir).agg({"correction_count": "sum"}).first()[0]
    assert trips + corrections == silver_trips(spark, sf_dir).count()
