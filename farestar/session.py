"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Pickup and dropoff times carry no zone; a fixed zone keeps every cast neutral.
    "spark.sql.session.timeZone": "UTC",
    # Numeric overflow must raise, never wrap or turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # One raw file may hold both casings of a column.
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "farestar",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the medallion jobs.

    ``shuffle_partitions`` is the starting number that adaptive execution coalesces from.
    Leave it unset on a cluster that configures it; size it as (shuffled bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written intermediates, on storage every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``.  Only a local session may
    leave it unset; it then uses a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="farestar-")
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def _is_local(spark: SparkSession) -> bool:
    """Whether the executors are threads of this process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")
