"""The schema of every landed month, recorded when it lands.

One row a landing: the month, how many files and bytes it has, its schema, and the stamp of what
was published.  A reader trusts a record only while the files still have that number and size, so
a month that was changed by other means is looked at again.  Records made before stamps were kept
have none.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import StructType

from farestar.lake import Lake
from farestar.sources.files import Files

RECORD = "month string, files long, bytes long, schema string, source string, landed_at timestamp"


def month_key(path: str) -> str:
    """Year folder and file of a month, which stay the same wherever the lake lies."""
    return "/".join(path.rstrip("/").split("/")[-2:])


def record_schemas(
    spark: SparkSession, lake: Lake, landed: list[tuple[str, StructType, str | None]]
) -> None:
    """Add a row for each (month path, schema, stamp); all files of a landed month share its schema."""
    files = Files(spark)
    rows = [
        (month_key(path), *files.size(path), schema.json(), stamp) for path, schema, stamp in landed
    ]
    if rows:
        spark.createDataFrame(rows, RECORD.rpartition(",")[0]).withColumn(
            "landed_at", F.current_timestamp()
        ).coalesce(1).write.mode("append").parquet(lake.schemas)


def _latest(spark: SparkSession, lake: Lake, *columns: str) -> list:
    """The columns of the latest landing of each month, as (month, last): one row a month."""
    if not Files(spark).exists(lake.schemas):
        return []
    return spark.read.schema(RECORD).parquet(lake.schemas).groupBy("month").agg(
        F.max_by(F.struct(*columns), "landed_at").alias("last")
    ).collect()


def recorded_stamps(spark: SparkSession, lake: Lake) -> dict[str, tuple[int, int, str]]:
    """Files and bytes of each landed month, and the stamp of what it was copied from."""
    found = _latest(spark, lake, "files", "bytes", "source")
    return {month: tuple(last) for month, last in found if last.source}


def recorded_schemas(spark: SparkSession, lake: Lake) -> dict[str, tuple[int, int, StructType]]:
    """Files, bytes and schema of the latest landing of each month: one row a month."""
    known: dict[str, StructType] = {}
    found = {}
    for month, last in _latest(spark, lake, "files", "bytes", "schema"):
        if last.schema not in known:
            known[last.schema] = StructType.fromJson(json.loads(last.schema))
        found[month] = (last.files, last.bytes, known[last.schema])
    return found
