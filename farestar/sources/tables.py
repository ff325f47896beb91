"""Parquet tables at fixed locations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_table_as(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` once and read it back; fails if the table exists, unless ``overwrite``.

    The columns come back in the order of ``df`` whether or not the table is partitioned.
    """
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    writer = writer.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
