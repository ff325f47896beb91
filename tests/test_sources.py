import datetime as dt
import os
import shutil

import pytest
from pyspark.errors import AnalysisException

from farestar.lake import Lake, source_path
from farestar.plans import medallion
from farestar.sources import bronze, landing, months
from farestar.sources.tables import create_table_as, read_table

BASE = (
    "CAST({vendor} AS {vendor_type}) AS VendorID,"
    " TIMESTAMP_NTZ'{day} 10:00:00' AS tpep_pickup_datetime,"
    " TIMESTAMP_NTZ'{day} 10:15:00' AS tpep_dropoff_datetime,"
    " CAST(2 AS {code_type}) AS passenger_count, 3.5D AS trip_distance,"
    " CAST(1 AS {code_type}) AS RatecodeID, 'N' AS store_and_fwd_flag,"
    " CAST(100 AS BIGINT) AS PULocationID, 200 AS DOLocationID,"
    " CAST(1 AS BIGINT) AS payment_type, 15.0D AS fare_amount, 0.5D AS extra, 0.5D AS mta_tax,"
    " 2.0D AS tip_amount, 0.0D AS tolls_amount, 1.0D AS improvement_surcharge,"
    " 19.0D AS total_amount, 2.5D AS congestion_surcharge"
)


def month(spark, day, extra="", vendor_type="BIGINT", code_type="DOUBLE"):
    columns = BASE.format(day=day, vendor=1, vendor_type=vendor_type, code_type=code_type)
    return spark.sql(f"SELECT {columns}{', ' + extra if extra else ''}")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def landed(spark, lake, tmp_path):
    """Four months of different shape, published under the source template and landed."""
    published = {
        ("2021", "03"): month(spark, "2021-03-05", "1.25D AS airport_fee"),
        ("2023", "07"): month(spark, "2023-07-05", "1.75D AS Airport_fee", code_type="BIGINT"),
        ("2024", "01"): month(
            spark, "2024-01-05", "1.25D AS airport_fee, 1.75D AS Airport_fee", code_type="STRING"
        ),
        ("2025", "02"): month(
            spark, "2025-02-05", "1.75D AS Airport_fee, 0.75D AS cbd_congestion_fee",
            vendor_type="INT", code_type="BIGINT",
        ),
    }
    base = str(tmp_path / "site")
    for key, df in published.items():
        df.coalesce(1).write.parquet(source_path(base, *key))
    report = landing.land_years(spark, 2021, 2025, lambda y, m: source_path(base, y, m), lake)
    return report


def test_grid_and_paths(spark):
    grid = months.month_grid(months.year_bounds(spark))
    rows = months.with_paths(grid).orderBy("year", "month").collect()
    assert len(rows) == 60 and (rows[0].year, rows[0].month) == ("2021", "01")
    assert rows[-1].source_path == "/trip-data/yellow_tripdata_2025-12.parquet"
    assert rows[-1].sink_folder == "yellow_tripdata/2025/"
    present = spark.createDataFrame([("2021", "01"), ("2021", "01")], "year string, month string")
    assert months.missing_months(grid, present).count() == 59


def test_landing_reports_missing_months(spark, landed, lake):
    status = {(r.year, r.month): r.status for r in landed.collect()}
    assert len(status) == 60
    assert sum(s == landing.LANDED for s in status.values()) == 4
    assert status["2025", "12"] == landing.MISSING
    found = bronze.landed_months(spark, lake).collect()
    assert {(r.year, r.month) for r in found} == {k for k, s in status.items() if s == "landed"}
    assert all(r.files == 1 and r.bytes > 0 for r in found)


def test_landed_month_is_unchanged(spark, landed, lake):
    path = lake.month_path(2024, "01")
    assert path.endswith("/bronze/yellow_tripdata/2024/yellow_tripdata_2024-01.parquet")
    copy = spark.read.parquet(path)
    assert {"airport_fee", "Airport_fee"} <= set(copy.columns)
    assert dict(copy.dtypes)["passenger_count"] == "string"
    assert all(f.endswith(".snappy.parquet") for f in os.listdir(path) if f.startswith("part"))


def test_landing_again_replaces_the_month(spark, lake, tmp_path):
    source = str(tmp_path / "once")
    month(spark, "2021-03-05").write.parquet(source)
    for _ in range(2):
        assert landing.land_month(spark, source, lake.month_path(2021, "03"))
    assert spark.read.parquet(lake.month_path(2021, "03")).count() == 1
    assert not landing.land_month(spark, source + "-absent", lake.month_path(2021, "04"))


def test_a_landing_that_fails_leaves_the_old_month(spark, lake, tmp_path):
    source, sink = tmp_path / "source", lake.month_path(2021, "03")
    month(spark, "2021-03-05").write.parquet(str(source))
    assert landing.land_month(spark, str(source), sink)
    month(spark, "2021-03-06").write.mode("append").parquet(str(source))
    part = sorted(p for p in source.iterdir() if p.name.startswith("part"))[0]
    with open(part, "r+b") as damaged:
        damaged.seek(4)
        damaged.write(b"\xff" * 64)
    (source / f".{part.name}.crc").write_bytes(b"")
    with pytest.raises(Exception):
        landing.land_month(spark, str(source), sink)
    assert spark.read.parquet(sink).count() == 1
    assert bronze.read_bronze(spark, lake).count() == 1
    assert os.listdir(os.path.dirname(sink)) == [os.path.basename(sink)]


def test_a_month_without_files_is_an_error(spark, landed, lake):
    os.makedirs(lake.month_path(2022, "01"))
    with pytest.raises(ValueError, match="without any data file"):
        bronze.read_bronze(spark, lake)


def test_a_landing_that_was_cut_short_is_an_error(spark, landed, lake):
    live = lake.month_path(2021, "03")
    folder, name = os.path.split(live)
    os.rename(live, f"{folder}/_replaced-{'0' * 32}-{name}")
    with pytest.raises(ValueError, match="cut short"):
        bronze.read_bronze(spark, lake)


def jobs_of(spark, action):
    """How many Spark jobs an action starts."""
    group = f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_reader_jobs_do_not_grow_with_months(spark, tmp_path):
    counts = []
    for months_landed in (2, 12):
        lake = Lake(str(tmp_path / f"lake{months_landed}"))
        base = str(tmp_path / f"site{months_landed}")
        keys = [("2021", f"{m:02d}") for m in range(1, months_landed + 1)]
        for year, m in keys:
            published = month(spark, f"2021-{m}-05", code_type="DOUBLE" if int(m) % 2 else "BIGINT")
            published.repartition(2).write.parquet(source_path(base, year, m))
        landing.land_months(spark, keys, lambda y, m: source_path(base, y, m), lake)
        counts.append(jobs_of(spark, lambda: bronze.read_bronze(spark, lake)))
    assert counts[0] == counts[1]


def test_a_changed_month_is_looked_at_again(spark, landed, lake):
    path = lake.month_path(2021, "03")
    month(spark, "2021-03-06", code_type="BIGINT").write.mode("append").parquet(path)
    counts = {r.passenger_count for r in bronze.read_bronze(spark, lake).collect() if r.source_year == "2021"}
    assert counts == {"2", "2.0"}


@pytest.fixture
def any_case(spark):
    """The session without this package's setting of case."""
    spark.conf.unset("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "false")
    yield
    spark.conf.set("spark.sql.caseSensitive", "true")


@pytest.mark.parametrize("recorded", [True, False])
def test_only_a_month_with_both_casings_needs_case_sensitive_names(spark, landed, lake, any_case, recorded):
    if not recorded:
        shutil.rmtree(lake.schemas)
    with pytest.raises(ValueError, match="caseSensitive"):
        bronze.read_bronze(spark, lake)
    shutil.rmtree(lake.month_path(2024, "01"))
    fees = {r.source_year: r.airport_fee for r in bronze.read_bronze(spark, lake).collect()}
    assert fees == {"2021": 1.25, "2023": 1.75, "2025": 1.75}


def test_unchanged_months_are_not_copied_again(spark, lake, tmp_path, monkeypatch):
    base, keys = str(tmp_path / "site"), [("2021", "01"), ("2021", "02"), ("2021", "03")]
    for key in keys[:2]:
        month(spark, f"2021-{key[1]}-05").write.parquet(source_path(base, *key))
    copied = []
    copy = landing.land_month
    monkeypatch.setattr(landing, "land_month", lambda s, source, sink: copied.append(sink) or copy(s, source, sink))

    def land():
        copied.clear()
        report = landing.land_months(spark, keys, lambda y, m: source_path(base, y, m), lake)
        return [r.status for r in report.orderBy("month").collect()], len(copied)

    assert land() == (["landed", "landed", "missing"], 3)
    assert land() == (["unchanged", "unchanged", "missing"], 1)
    month(spark, "2021-02-06").write.mode("append").parquet(source_path(base, "2021", "02"))
    month(spark, "2021-03-05").write.parquet(source_path(base, "2021", "03"))
    assert land() == (["unchanged", "landed", "landed"], 2)
    shutil.rmtree(lake.month_path(2021, "01"))
    assert land() == (["landed", "unchanged", "unchanged"], 1)
    assert bronze.read_bronze(spark, lake).count() == 4


def test_blank_text_codes_count_as_zero(spark, lake):
    columns = BASE.format(day="2024-01-05", vendor=1, vendor_type="INT", code_type="STRING")
    df = spark.sql(f"SELECT {columns}").selectExpr("* EXCEPT (passenger_count)", "' ' AS passenger_count")
    df.write.parquet(lake.month_path(2024, "01"))
    assert medallion.build_silver(spark, lake).first().passenger_count == 0


def test_drifting_months_read_as_one_table(spark, landed, lake):
    raw = bronze.read_bronze(spark, lake)
    assert raw.columns == [*bronze.TRIP_COLUMNS, *bronze.SOURCE_COLUMNS] and len(raw.columns) == 22
    types = dict(raw.dtypes)
    assert types["VendorID"] == types["PULocationID"] == "int"
    assert types["passenger_count"] == types["payment_type"] == "string"
    rows = {r.source_year: r for r in raw.collect()}
    assert {y: r.airport_fee for y, r in rows.items()} == {
        "2021": 1.25, "2023": 1.75, "2024": 1.25, "2025": 1.75
    }
    assert {y: r.passenger_count for y, r in rows.items()} == {
        "2021": "2.0", "2023": "2", "2024": "2", "2025": "2"
    }
    assert {y: r.cbd_congestion_fee for y, r in rows.items()} == {
        "2021": None, "2023": None, "2024": None, "2025": 0.75
    }
    assert rows["2023"].source_file == "yellow_tripdata_2023-07.parquet"
    assert rows["2023"].tpep_pickup_datetime == dt.datetime(2023, 7, 5, 10)


def test_single_files_read_like_folders(spark, lake, tmp_path):
    """A month copied as one file, the way the published pipeline stores it."""
    month(spark, "2022-06-05").coalesce(1).write.parquet(str(tmp_path / "one"))
    part = next(p for p in (tmp_path / "one").iterdir() if p.name.startswith("part"))
    target = lake.month_path(2022, "06")
    os.makedirs(os.path.dirname(target))
    with open(target, "wb") as copy:
        copy.write(part.read_bytes())
    row = bronze.read_bronze(spark, lake).first()
    assert (row.source_file, row.source_year) == ("yellow_tripdata_2022-06.parquet", "2022")


def test_a_month_whose_own_files_disagree(spark, lake):
    path = lake.month_path(2022, "06")
    month(spark, "2022-06-05", code_type="DOUBLE").write.parquet(path)
    month(spark, "2022-06-06", code_type="BIGINT").write.mode("append").parquet(path)
    rows = bronze.read_bronze(spark, lake).collect()
    assert sorted(r.passenger_count for r in rows) == ["2", "2.0"]


def test_view_is_evaluated_when_read(spark, landed, lake):
    bronze.create_raw_view(spark, lake, "raw_view_test")
    assert spark.sql("SELECT count(*) FROM raw_view_test").first()[0] == 4


def test_tables_are_created_once(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert create_table_as(df, path).collect() == df.collect()
    with pytest.raises(AnalysisException):
        create_table_as(df, path)
    other = spark.sql("SELECT 3 AS a, 4 AS b")
    assert create_table_as(other, path, overwrite=True, partition_by=["a"]).columns == ["a", "b"]
    assert read_table(spark, path).count() == 1


def test_the_whole_lake(spark, landed, lake):
    silver = medallion.build_silver(spark, lake)
    gold = medallion.build_gold(spark, lake)
    assert silver.count() == 4 and gold["fact_trips"].count() == 4
    silver_report = medallion.check_silver(spark, lake).collect()
    gold_report = medallion.check_gold(spark, lake).collect()
    assert len(silver_report) == 18 and {r.result for r in silver_report} == {"PASS"}
    failed = [r.test for r in gold_report if r.result == "FAIL"]
    # These few trips hold no correction.
    assert failed == ["G11: fact_corrections not empty"]


def test_steps_from_the_command_line(spark, landed, lake, capsys):
    from farestar.__main__ import main, parse

    for step in ("silver", "gold", "check"):
        main([step, "--root", lake.root])
    printed = capsys.readouterr().out
    assert "S18: data loss < 10%" in printed and "G16: Gold revenue" in printed
    with pytest.raises(SystemExit):
        parse(["land", "--root", lake.root])
    with pytest.raises(SystemExit):
        parse(["report", "--root", lake.root])


@pytest.mark.parametrize("name", ["overview", "revenue", "zones", "temporal", "corrections"])
def test_reports_are_written_whole_and_in_order(spark, sf_dir, tmp_path, name):
    from farestar.__main__ import main
    from harness.registry import all_queries
    from harness.trips import gold_tables, lake_of

    gold_tables(spark, sf_dir)
    out = str(tmp_path / name)
    main(["report", "--root", lake_of(spark, sf_dir).root, "--name", name, "--out", out, "--format", "csv"])
    written = spark.read.option("header", True).csv(out)
    registered = all_queries()[f"report_{name}"](spark, sf_dir)
    assert written.count() == registered.count()
    if name == "overview":
        assert written.count() > 100
    parts = sorted(p for p in os.listdir(out) if p.startswith("part"))
    first = [row for p in parts for row in open(f"{out}/{p}").read().splitlines()[1:]]
    keys = [row.split(",")[0] for row in first]
    assert name not in ("overview", "corrections") or keys == sorted(keys)
