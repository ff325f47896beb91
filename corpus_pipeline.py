"""The corpus pipeline: stages over documents, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farestar.llm import chaining, exact, minhash, packing, toxicity
from farestar.llm.common import bounded_batches, documents, id_remainder, keep_rows, written

#: Executors keep native memory of all stages before, so tasks hold less at once than in an operator
#: that runs alone: bytes of an Arrow batch, characters of a block that is packed.
BATCH_BYTES = 2 << 20
PACKED_CHARS = 1 << 22


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the labels of a bounded sample train it.

    Rows whose crc32 of doc_id modulo 5 is 0 are never learned from.  The texts to learn from
    are those of ``docs``, which is the documents table in the first stage.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(id_remainder(5) != 0))
    return toxicity.drop_predicted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    return keep_rows(docs, exact.exact_groups(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates."""
    return keep_rows(docs, minhash.near_duplicates(docs))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages that an earlier one has are cut from text, n_chars follows it."""
    cut = chaining.remove_passages(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, block_chars=PACKED_CHARS
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_windows),
]

#: The stages score, hash, align and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    bounded_batches(spark, BATCH_BYTES)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
