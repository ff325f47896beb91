"""Copies published months into the bronze layer, unchanged."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farestar.lake import REPLACED, Lake
from farestar.sources.files import Files
from farestar.sources.months import month_grid, year_bounds
from farestar.sources.schemas import month_key, record_schemas, recorded_stamps

LANDED, UNCHANGED, MISSING = "landed", "unchanged", "missing"
REPORT_SCHEMA = "year string, month string, status string, path string"

# Months in flight at once: enough to fill the cluster while one month drains its last tasks.
CONCURRENT_MONTHS = 4

SourcePath = Callable[[str, str], str]


def land_month(spark: SparkSession, source: str, sink: str) -> StructType | None:
    """Copy one month and return its schema; None if the source does not exist.

    The copy keeps the names and types of the source file and needs no shuffle.  It is written
    beside an earlier copy and takes its place when it is complete, so a run that fails leaves
    the earlier month as it was.
    """
    try:
        month = spark.read.parquet(source)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    parent, _, name = sink.rstrip("/").rpartition("/")
    run = uuid.uuid4().hex
    fresh, replaced = f"{parent}/_landing-{run}-{name}", f"{parent}/{REPLACED}{run}-{name}"
    files = Files(spark)
    try:
        month.write.option("compression", "snappy").parquet(fresh)
    except Exception:
        files.delete(fresh)
        raise
    again = files.exists(sink)
    if again:
        files.rename(sink, replaced)
    try:
        files.rename(fresh, sink)
    except Exception:
        if again:
            files.rename(replaced, sink)
        raise
    if again:
        files.delete(replaced)
    return month.schema


def land_months(
    spark: SparkSession, months: list[tuple[str, str]], source: SourcePath, lake: Lake
) -> DataFrame:
    """Lands the given (year, month) pairs and reports one row for each.

    Every month is its own distributed job; a failing job fails the call once the others have
    finished, while a month that is not published yet is only reported.  A month is not copied
    again while what is published has the stamp of the last landing and the copy its size.
    """
    files, known = Files(spark), recorded_stamps(spark, lake)

    def land(key: tuple[str, str]) -> tuple[str, StructType | None, str | None]:
        published, sink = source(*key), lake.month_path(*key)
        stamp = files.stamp(published)
        before = known.get(month_key(sink))
        if before and stamp == before[2] and files.exists(sink) and files.size(sink) == before[:2]:
            return UNCHANGED, None, None
        schema = land_month(spark, published, sink)
        return LANDED if schema else MISSING, schema, stamp

    with ThreadPoolExecutor(CONCURRENT_MONTHS) as pool:
        landed = list(pool.map(land, months))
    record_schemas(spark, lake, [
        (lake.month_path(*key), schema, stamp)
        for key, (_, schema, stamp) in zip(months, landed) if schema
    ])
    report = [(*key, status, lake.month_path(*key)) for key, (status, *_) in zip(months, landed)]
    return spark.createDataFrame(report, REPORT_SCHEMA)


def land_year(spark: SparkSession, year: int, source: SourcePath, lake: Lake) -> DataFrame:
    return land_years(spark, year, year, source, lake)


def land_years(
    spark: SparkSession, start_year: int, end_year: int, source: SourcePath, lake: Lake
) -> DataFrame:
    """Lands all months of the years, in order.  The grid is 12 rows a year."""
    grid = month_grid(year_bounds(spark, start_year, end_year)).orderBy("year", "month")
    months = [(row.year, row.month) for row in grid.collect()]
    return land_months(spark, months, source, lake)
