"""Tolerant reader of the raw months.

Published months drift: a column is BIGINT in one year and DOUBLE in the next, changes its
casing, or does not exist yet.  One read schema cannot bind them all, so months are grouped
by physical schema (a handful of groups), each group is scanned natively with its own schema
and projected onto the declared one, and the groups are united.  Only month paths and schemas
reach the driver; landed months have their schema on record, footers of others are read by tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from farestar.functions.numbers import blank_as_zero
from farestar.lake import REPLACED, TRIP_DATASET, Lake
from farestar.sources.files import Files
from farestar.sources.schemas import month_key, recorded_schemas

# Declared column, physical column (matched by exact name), declared type.
RAW_FIELDS = (
    ("VendorID", "VendorID", "int"),
    ("tpep_pickup_datetime", "tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "string"),
    ("trip_distance", "trip_distance", "double"),
    ("RatecodeID", "RatecodeID", "string"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("PULocationID", "PULocationID", "int"),
    ("DOLocationID", "DOLocationID", "int"),
    ("payment_type", "payment_type", "string"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee_lower", "airport_fee", "double"),
    ("airport_fee_upper", "Airport_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
)
# Columns whose physical type drifts; the view shows them as text.
CODE_FIELDS = ("passenger_count", "RatecodeID", "payment_type")
# Columns stored as INT in some months and as BIGINT in others.
ID_FIELDS = ("VendorID", "PULocationID", "DOLocationID")

TRIP_COLUMNS = (
    *(name for name, _, _ in RAW_FIELDS[:18]), "airport_fee", "cbd_congestion_fee",
)
SOURCE_COLUMNS = ("source_file", "source_year")

# .../<dataset>/<year>/<month>.parquet, a file or a folder of part files.
_MONTH_IN_PATH = rf"^(.*/{TRIP_DATASET}/([^/]+)/([^/]+\.parquet))(/[^/]+)?$"


# The lower-case column wins.
AIRPORT_FEE = "coalesce(airport_fee_lower, airport_fee_upper)"


def merge_airport_fee(raw: DataFrame) -> DataFrame:
    """Replaces the two cased inputs by one column."""
    merged = raw.selectExpr("*", f"{AIRPORT_FEE} AS airport_fee")
    return merged.drop("airport_fee_lower", "airport_fee_upper")


def list_raw_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per stored raw file: month path, source year, file name, path and size."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(lake.trips_glob)
        .select("path", "length")
    )
    return files.select(
        F.regexp_extract("path", _MONTH_IN_PATH, 1).alias("month_path"),
        F.regexp_extract("path", _MONTH_IN_PATH, 2).alias("source_year"),
        F.regexp_extract("path", _MONTH_IN_PATH, 3).alias("source_file"),
        "path",
        "length",
    )


def landed_months(spark: SparkSession, lake: Lake) -> DataFrame:
    """Months present in the lake: (year, month, files, bytes)."""
    month = F.regexp_extract("source_file", r"-(\d{2})\.parquet$", 1)
    return (
        list_raw_files(spark, lake)
        .groupBy(F.col("source_year").alias("year"), month.alias("month"))
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


@dataclass
class _Group:
    """Paths that share a physical schema and a layout (one file or a folder for a month)."""

    schema: StructType
    in_folders: bool
    paths: list[str] = field(default_factory=list)


def _landed(spark: SparkSession, lake: Lake) -> list[tuple[str, bool, int, int]]:
    """(month path, stored as folder, files, bytes) of every month; raises if one is broken."""
    months = (
        list_raw_files(spark, lake)
        .groupBy("month_path", F.expr("path <> month_path").alias("in_folder"))
        .agg(F.count("*"), F.sum("length"))
        .orderBy("month_path")
    )
    found = [tuple(row) for row in months.collect()]
    keys = {month_key(path) for path, *_ in found}
    files = Files(spark)
    empty = [path for path in files.matching(lake.trips_glob) if month_key(path) not in keys]
    if empty:
        raise ValueError(f"landed months without any data file: {empty}")
    for path in files.matching(lake.replaced_glob):
        year, name = month_key(path).split("/")
        if f"{year}/{name[len(REPLACED) + 33:]}" not in keys:
            raise ValueError(f"a landing was cut short, its month is kept in {path}")
    return found


BOTH_CASINGS = "set spark.sql.caseSensitive to true: a month holds both casings of a column"


def _schema_groups(spark: SparkSession, lake: Lake) -> list[_Group]:
    """Month paths grouped by physical schema.

    Recorded schemas cost no footer.  Months without a record are merged together; where types
    clash the list is halved, so the number of jobs follows the number of schema changes.  A
    month whose own files disagree is split into its files the same way.

    Columns are bound by exact name in any session.  Only a month that holds two names equal but
    for case needs a case-sensitive one, and is refused in another.
    """
    groups: dict[tuple, _Group] = {}
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"

    def add(schema: StructType, in_folder: bool, paths: list[str]) -> None:
        if not exact and len({name.lower() for name in schema.names}) < len(schema.names):
            raise ValueError(f"{BOTH_CASINGS}: {paths[0]}")
        types = frozenset((f.name, f.dataType.simpleString()) for f in schema.fields)
        groups.setdefault((types, in_folder), _Group(schema, in_folder)).paths.extend(paths)

    def merged(paths: list[str]) -> StructType | None:
        try:
            return spark.read.option("mergeSchema", True).parquet(*paths).schema
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE" in str(error):
                return None
            if "COLUMN_ALREADY_EXISTS" in str(error):
                raise ValueError(BOTH_CASINGS) from error
            raise

    def infer(paths: list[str], in_folder: bool, are_files: bool = False) -> None:
        schema = merged(paths) if paths else None
        if schema is not None:
            add(schema, in_folder, paths)
        elif len(paths) > 1:
            half = len(paths) // 2
            infer(paths[:half], in_folder, are_files)
            infer(paths[half:], in_folder, are_files)
        elif paths and not are_files:
            parts = list_raw_files(spark, lake).where(F.col("month_path") == paths[0])
            infer([row.path for row in parts.select("path").orderBy("path").collect()], in_folder, True)

    recorded = recorded_schemas(spark, lake)
    unknown: dict[bool, list[str]] = {}
    for path, in_folder, files, size in _landed(spark, lake):
        known = recorded.get(month_key(path))
        if known and known[:2] == (files, size):
            add(known[2], in_folder, [path])
        else:
            unknown.setdefault(in_folder, []).append(path)
    for in_folder, paths in unknown.items():
        infer(paths, in_folder)
    return list(groups.values())


def _bind(group: DataFrame, types: dict[str, str]) -> list[str]:
    """Expressions that project one natively scanned group onto the declared fields."""
    physical = {f.name: f.dataType.simpleString() for f in group.schema.fields}

    def column(name: str, stored_as: str, declared: str) -> str:
        wanted = types.get(name, declared)
        if stored_as not in physical:
            return f"CAST(NULL AS {wanted}) AS {name}"
        if physical[stored_as] == "string" and name in CODE_FIELDS and wanted != "string":
            return f"CAST({blank_as_zero(stored_as)} AS {wanted}) AS {name}"
        # An unneeded cast would keep a filter from reaching the scan.
        cast = physical[stored_as] != wanted
        return f"CAST({stored_as} AS {wanted}) AS {name}" if cast else f"{stored_as} AS {name}"

    return [column(*declared) for declared in RAW_FIELDS]


def _source_columns(in_folders: bool) -> list[str]:
    """File name and year, counted from the end of the path (a pattern per row is 20x dearer)."""

    def part(position: int) -> str:
        return f"substring_index(substring_index(_metadata.file_path, '/', -{position}), '/', 1)"

    file_position = 2 if in_folders else 1
    return [f"{part(file_position)} AS source_file", f"{part(file_position + 1)} AS source_year"]


def _read(
    spark: SparkSession, lake: Lake, types: dict[str, str], with_source: bool
) -> DataFrame:
    scans = []
    for group in _schema_groups(spark, lake):
        stored = spark.read.schema(group.schema).parquet(*group.paths)
        source = _source_columns(group.in_folders) if with_source else []
        scans.append(stored.selectExpr(*_bind(stored, types), *source))
    return merge_airport_fee(reduce(DataFrame.unionByName, scans))


def read_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    """The published view: all landed trips under the declared schema, 22 columns."""
    return _read(spark, lake, dict.fromkeys(CODE_FIELDS, "string"), with_source=True).select(*TRIP_COLUMNS, *SOURCE_COLUMNS)


def read_bronze_trips(spark: SparkSession, lake: Lake) -> DataFrame:
    """The same trips, shaped for the cleaning step: no source columns, codes as DOUBLE.

    Spark builds the file metadata of every row once a query has mentioned it, even if the
    column is dropped later, and codes as text would be formatted only to be parsed again.  Ids
    are BIGINT: the optimizer takes a filter through a widening cast, not a narrowing one.
    """
    types = dict.fromkeys(CODE_FIELDS, "double") | dict.fromkeys(ID_FIELDS, "bigint")
    return _read(spark, lake, types, with_source=False).select(*TRIP_COLUMNS)


def create_raw_view(spark: SparkSession, lake: Lake, name: str = "vw_yellow_taxi_raw") -> None:
    """Registers the raw trips as a temporary view, evaluated when it is read."""
    read_bronze(spark, lake).createOrReplaceTempView(name)
