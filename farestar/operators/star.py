"""Joins of facts with dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def star_join(fact: DataFrame, dates: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Fact rows with their day and payment attributes.

    Left joins: a trip without a payment type keeps its amounts.  No broadcast hint is given;
    the optimizer broadcasts both dimensions by their size (a few kilobytes) and would shuffle
    if they ever outgrew its threshold.
    """
    return fact.join(dates, "date_key", "left").join(payment_types, "payment_key", "left")


def rows_not_in(rows: DataFrame, key: str, lookup: DataFrame) -> DataFrame:
    """Rows whose key is NOT IN the lookup, with SQL's treatment of NULL.

    A NULL key is never reported, and a NULL in the lookup hides every row; an empty lookup
    reports all rows.  A plain anti join keeps NULL keys, so both cases are decided from two
    counts of the lookup.  Spark plans the SQL form only as a broadcast of the lookup,
    whatever its size; here the optimizer picks the join by size.
    """
    keys = lookup.select(key)
    size = keys.agg(F.expr("count(*)")).scalar()
    nulls = keys.agg(F.expr(f"count_if({key} IS NULL)")).scalar()
    known = F.col(key).isNotNull() & (nulls == 0)
    return rows.join(keys, key, "left_anti").where((size == 0) | known)


def orphan_keys(fact: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Payment keys missing from the dimension, with their number of fact rows."""
    per_key = fact.groupBy("payment_key").agg(F.expr("count(*) AS fact_rows"))
    return rows_not_in(per_key, "payment_key", payment_types)
