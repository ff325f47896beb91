"""One query per operator over the whole documents table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farestar.llm import alignment, audit, bpe, chaining, dac, exact, language, minhash, neighbours, packing, quality, substrings, toxicity
from farestar.llm.common import documents, id_remainder

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.decode(bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = id_remainder(5) == 0
    model = toxicity.fit(docs, labels.where(~held))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", "predicted"
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.rule_ledger(documents(spark, sf_dir))
    base = sum(quality.BIT[rule] for rule in quality.BASE)
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(f"failure_bits & {base}L <> 0").alias("base_failed"),
        quality.kept_by(max(quality.POLICIES)).alias("kept"),
        "failure_bits",
    )


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir))


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op7_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return dac.read_codes(dac.write_codes(documents(spark, sf_dir), path, end_id=2))


def op8_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.summary(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held = id_remainder(4) == 2
    model = language.fit(docs.where(~held))
    return language.identify(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score"
    )


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit.audit(documents(spark, sf_dir), labels)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of_every(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def all_queries() -> dict[str, Query]:
    found = {
        name: query for name, query in globals().items()
        if name.startswith("op") and callable(query)
    }
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
