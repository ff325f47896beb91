"""Interaction of filters: what each removes, alone, after others and on average over all orders.

Filters on a text's own content are one bit each.  The filter on copies is an existential
self-join: a row fails it if a left-semi join on hash, exact text and a smaller doc_id finds a
partner.  The ids that fail it are united with the failure bits of all others, and bit
combinations are counted by part; everything about any order of filters follows from those counts.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from farestar.llm.common import written

#: Filters in the order of their bits.
FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
COPY = "E"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_failures(text: Column) -> Column:
    """The bits of the filters that a text fails by itself (not NULL)."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    measured = F.struct(
        F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("different"),
        (F.length(text) - F.length(F.translate(text, _LETTERS, ""))).alias("capitals"),
        F.length(text).alias("chars"), text.rlike("[#$%&*|]").alias("symbol"),
    )
    rules = {
        "A": lambda m: m["words"] < 50,
        "B": lambda m: 100 * m["different"].cast("long") < 65 * m["words"].cast("long"),
        "C": lambda m: 100 * m["capitals"].cast("long") > 5 * m["chars"].cast("long"),
        "D": lambda m: m["symbol"],
    }

    def bits(m: Column) -> Column:
        total = F.lit(0)
        for name, rule in rules.items():
            total = total + F.when(rule(m), BIT[name]).otherwise(0)
        return total

    # One element, so that the words of a text are split once and shared by the rules.
    return F.transform(F.array(measured), bits)[0]


def copies(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, text, hash, ...) whose text a row with a smaller doc_id has too.

    Texts are only shuffled where their hash repeats.  The side that is searched holds one row a
    text, its least doc_id, summed before the shuffle; the other side's copies of one text may be
    split over many tasks.
    """
    repeated = written(
        rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").select("hash"),
        "audit_hashes",
    )
    candidates = written(rows.join(repeated, "hash", "left_semi"), "audit_candidates")
    first = written(
        candidates.groupBy("hash", "text").agg(F.min("doc_id").alias("least")), "audit_first"
    )
    left, right = candidates.alias("l"), first.alias("r")
    partner = F.expr("l.hash = r.hash AND l.text = r.text AND r.least < l.doc_id")
    return left.join(right, partner, "left_semi")


def failure_combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good and toxic: how many rows of a part fail exactly those filters.

    A NULL text is empty; a NULL source is the part of the empty string.  Rows without doc_id
    are no one's copy and have no label; repeated rows count once each.  A document with several
    labels is good, or toxic, if one of them says so.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    key = ["doc_id", "part", "hash"]
    own = rows.select(*key, own_failures(F.col("text")).alias("bits"), F.lit(1).alias("rows"))
    copied = copies(rows.where("doc_id IS NOT NULL")).select(
        *key, F.lit(BIT[COPY]).alias("bits"), F.lit(0).alias("rows")
    )
    failed = own.unionByName(copied).groupBy(*key).agg(
        F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows")
    )
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    ).where("doc_id IS NOT NULL AND (good = 1 OR toxic = 1)")
    return failed.join(marks, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("rows").alias("n"),
        F.sum(F.expr("CASE WHEN good = 1 THEN rows ELSE 0 END")).alias("good"),
        F.sum(F.expr("CASE WHEN toxic = 1 THEN rows ELSE 0 END")).alias("toxic"),
    )


def _steps() -> Column:
    """Every order of the filters and every step of it: a fixed list of 600 structs."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            rows.append(f"('{''.join(order)}', {step}, {before}, {BIT[name]})")
            before |= BIT[name]
    fields = "filter_order: string, step: int, before: int, bit: int"
    return F.expr(f"CAST(array({', '.join(rows)}) AS array<struct<{fields}>>)")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step, counted within the part.

    kept, removed, redundant (fails, but was removed before), unique_fails (fails nothing else),
    good_lost, toxic_lost and shapley: what the filter removes, summed over all orders.  A row
    that fails k filters is removed by each of them in one k-th of the orders.  An empty table
    has no part and gives no row.
    """
    found = written(failure_combinations(docs, labels), "audit_combinations")
    # At most one entry a combination of bits.
    parts = found.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("found"))
    orders = factorial(len(FILTERS))

    def total(condition: str, of: str = "e.n") -> str:
        return f"aggregate(found, 0L, (sum, e) -> sum + CASE WHEN {condition} THEN {of} ELSE 0L END)"

    fails, fresh = "e.bits & x.bit <> 0", "e.bits & x.before = 0"
    return parts.select("part", "found", F.explode(_steps()).alias("x")).selectExpr(
        "part", "x.filter_order", "x.step",
        total("e.bits & (x.before | x.bit) = 0") + " AS kept",
        total(f"{fails} AND {fresh}") + " AS removed",
        total(f"{fails} AND NOT ({fresh})") + " AS redundant",
        total("e.bits = x.bit") + " AS unique_fails",
        total(f"{fails} AND {fresh}", "e.good") + " AS good_lost",
        total(f"{fails} AND {fresh}", "e.toxic") + " AS toxic_lost",
        total(fails, f"e.n * ({orders} div bit_count(e.bits))") + " AS shapley",
    )
