"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farestar.llm.common import SPACES, text_digest, texts, written

PREFIX = 64


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, text_sha256, keep_id, group_size, kept.

    Texts are equal when identical without white space (``SPACES``).  Rows are first grouped by
    the length of that form; rows of a length met twice are grouped by a hash of its first 64
    characters; only rows whose length and prefix both repeat are grouped by the full hash.
    The row with the longest original text stays, then the smallest doc_id; of identical
    repeated rows exactly one stays.  NULL text counts as empty, empty texts are equal to each
    other, and a NULL doc_id ranks after all others.  Groupings carry counts only, summed
    before the shuffle, so a group of any size costs one row per task.
    """
    bare = F.translate("text", SPACES, "")
    measured = texts(docs).select("doc_id", "text", bare.alias("bare"))
    rows = written(
        measured.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.length("bare").alias("length"),
            F.xxhash64(F.substring("bare", 1, PREFIX)).alias("prefix"),
            F.length("text").alias("chars"),
            F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256"),
            text_digest().alias("digest"),
        ),
        "exact_rows",
    )
    lengths = written(
        rows.groupBy("length").count().where("count > 1").select("length"), "exact_lengths"
    )
    prefixes = written(
        rows.select("length", "prefix").join(lengths, "length", "left_semi")
        .groupBy("length", "prefix").count().where("count > 1").select("length", "prefix"),
        "exact_prefixes",
    )
    # ~x falls as x rises and cannot overflow; NULL, the least value of a struct field, loses.
    best = F.max(F.expr("struct(chars, ~doc_id AS id, ~row AS row)")).alias("best")
    groups = written(
        rows.join(prefixes, ["length", "prefix"], "left_semi")
        .groupBy("text_sha256").agg(F.count("*").alias("group_size"), best)
        .where("group_size > 1")
        .select(
            "text_sha256", "group_size",
            F.expr("~best.id").alias("keep_id"), F.expr("~best.row").alias("keep_row"),
        ),
        "exact_groups",
    )
    found = rows.join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id", "digest", "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )
