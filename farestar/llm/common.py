"""Helpers shared by the document operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farestar.session import scratch_folder
from farestar.sources.files import Files

#: The white space that separates words: \x20 and \x09-\x0D.  ``bytes.split()`` splits on the same.
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only doc_id (long) and text (null: empty); extra columns cannot clash with what follows."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def written(df: DataFrame, purpose: str, instead_of: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors.

    ``instead_of`` names a scratch folder that only served to make these rows; it is deleted
    once they are written.
    """
    return written_to(df, scratch_folder(df.sparkSession, purpose), instead_of)


def written_to(df: DataFrame, folder: str, instead_of: str | None = None) -> DataFrame:
    """``written`` to a scratch folder whose name the caller keeps, to delete it later."""
    spark = df.sparkSession
    df.write.parquet(folder)
    if instead_of:
        Files(spark).delete(instead_of)
    return spark.read.schema(df.schema).parquet(folder)


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let Python tasks get their rows in Arrow batches of at most ``most`` bytes, or one row.

    The default of 64 MB is held several times over by each task, in the JVM and in Python.  A
    smaller number of bytes that is set already stays.
    """
    held = spark.conf.get(_BATCH_CONF)
    if not held.isdigit() or not 0 < int(held) <= most:
        spark.conf.set(_BATCH_CONF, str(most))


def free_shuffles(spark: SparkSession) -> None:
    """Let every job's shuffle files go when it ends, instead of when the driver collects garbage."""
    spark.conf.set(_CLEANUP_CONF, "true")


def tidy(run):
    """``run`` for mapInArrow, after which its task hands freed memory back to the machine.

    Python workers serve many tasks, and keep what one has freed unless they are told not to.
    """
    def tidied(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def id_remainder(modulus: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``modulus``; NULL ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``decided`` (doc_id, digest, kept) keeps, in the columns of ``docs``.

    ``digest`` is ``text_digest()`` of the text.  Texts are not shuffled unless a join needs it:
    the few keys that are dropped meet the rows.  Of identical rows of which one is kept, one
    stays.
    """
    key = ["id", "digest"]
    verdicts = (
        decided.select(F.col("doc_id").alias("id"), "digest", F.col("kept").cast("int").alias("kept"))
        .groupBy(*key).agg(F.count("*").alias("rows"), F.sum("kept").alias("kept"))
        .where("rows > 1 OR kept = 0")
    )
    verdicts = written(verdicts, "verdicts")
    # Whole rows as one column, so that no column of ``docs`` clashes with the key.
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("id"), text_digest().alias("digest"),
    )

    def meets(table: DataFrame, how: str) -> DataFrame:
        left, right = keyed.alias("l"), table.alias("r")
        on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
        return left.join(right, on, how)

    settled = meets(verdicts, "left_anti").select("row.*")
    repeated = verdicts.where("kept > 0")
    if repeated.isEmpty():
        return settled
    return settled.unionByName(meets(repeated, "left_semi").dropDuplicates(key).select("row.*"))


def text_digest() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
