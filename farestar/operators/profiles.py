"""One-pass profiles of the raw table: what the rules remove, what is NULL, what is flagged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from farestar.operators.cleaning import CORRECTION, KEEP_ALL, KEEP_RULES, TRIP_STATUS, VALID
from farestar.operators.lines import as_lines, text

REPAIRED_COLUMNS = (
    "passenger_count", "RatecodeID", "store_and_fwd_flag",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
)


def _share(part: str) -> str:
    """NULL for an empty table."""
    return f"try_divide(CAST({part} AS DOUBLE), rows)"


def filter_profile(raw: DataFrame) -> DataFrame:
    """For each rule, the rows it removes alone and the rows no earlier rule removed.

    The last row, ``any``, counts the rows that at least one rule removes.
    """
    failed = [f"NOT coalesce({rule}, false) AS {name}" for name, rule in KEEP_RULES.items()]
    first = "CASE " + " ".join(f"WHEN {name} THEN '{name}'" for name in KEEP_RULES) + " END"
    counts = (
        raw.selectExpr(*failed)
        .selectExpr("*", f"{first} AS first")
        .agg(
            F.expr("count(*) AS rows"),
            F.expr("count(first) AS any"),
            *(F.expr(f"count_if({name}) AS {name}") for name in KEEP_RULES),
            *(F.expr(f"count_if(first = '{name}') AS first_{name}") for name in KEEP_RULES),
        )
    )
    lines = [(name, name, f"first_{name}") for name in KEEP_RULES] + [("any", "any", "any")]
    return as_lines(
        counts,
        (
            {
                "rule": text(rule),
                "removed_alone": alone,
                "removed_in_order": in_order,
                "share_alone": _share(alone),
            }
            for rule, alone, in_order in lines
        ),
    )


def null_profile(raw: DataFrame, columns: Sequence[str] = REPAIRED_COLUMNS) -> DataFrame:
    """NULL rows and NULL share of each column."""
    counts = raw.agg(
        F.expr("count(*) AS rows"), *(F.expr(f"count({name}) AS n_{name}") for name in columns)
    )
    return as_lines(
        counts,
        (
            {
                "column_name": text(name),
                "null_rows": f"rows - n_{name}",
                "null_share": _share(f"rows - n_{name}"),
            }
            for name in columns
        ),
    )


def status_profile(raw: DataFrame) -> DataFrame:
    """Rows and share of the raw table by outcome: valid, correction or removed."""
    outcomes = (VALID, CORRECTION, "removed")
    outcome = f"CASE WHEN {KEEP_ALL} THEN {TRIP_STATUS} ELSE 'removed' END AS outcome"
    counts = raw.selectExpr(outcome).agg(
        F.expr("count(*) AS rows"),
        *(F.expr(f"count_if(outcome = '{name}') AS {name}") for name in outcomes),
    )
    return as_lines(
        counts,
        ({"trip_status": text(o), "trips": o, "share": _share(o)} for o in outcomes),
    )
