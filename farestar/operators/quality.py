"""Data-quality rules as data, evaluated together instead of one scan per rule.

Every table is reduced to one row of measures (plain conditional aggregates), the rows of all
tables meet in a union, and the rules turn them into (test, result, details).  A failing rule
is a row of the report, not an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from farestar.functions.numbers import TOTAL, sum_cents, total
from farestar.operators.cleaning import CORRECTION, VALID
from farestar.operators.lines import as_lines, meet, text


@dataclass(frozen=True)
class Rule:
    """Printed name, and how the measure (``{}``, a column named by the code) is judged."""

    name: str
    passes: str = "{} = 0"
    details: str = "CAST({} AS STRING)"

    @property
    def code(self) -> str:
        return self.name.split(":")[0]


def _report(measures: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(test, result, details), a row per rule; a NULL measure fails."""
    return as_lines(
        measures,
        (
            {
                "test": text(rule.name),
                "result": f"if({rule.passes.format(rule.code)}, 'PASS', 'FAIL')",
                "details": rule.details.format(rule.code),
            }
            for rule in rules
        ),
    )


def _violations(condition: str, alias: str) -> Column:
    return F.expr(f"count_if({condition}) AS {alias}")


def _sum_or_zero(name: str, alias: str) -> Column:
    return F.expr(f"coalesce(sum({name}), 0) AS {alias}")


def _rows(alias: str) -> Column:
    return F.expr(f"count(*) AS {alias}")


# --- cleaned trips ---------------------------------------------------------------------------

# Violations counted for each rule of the cleaned table.  As in any SQL filter, a condition
# that is NULL is not counted.
#
# Ranges and NULLs can be ruled out from the statistics of a Parquet row group, so these rules
# run as a filter that skips every clean row group unread.  The codes are integers, so "not
# among 1 and 2" is a range as well.
RANGE_VIOLATIONS = {
    "S02": "vendor_id < 1 OR vendor_id > 2",
    "S04": "trip_duration_minutes < 1 OR trip_duration_minutes > 1440",
    "S05": "passenger_count < 0",
    "S06": "trip_distance_miles <= 0",
    "S08": "pickup_location_id < 1 OR pickup_location_id > 265",
    "S09": "dropoff_location_id < 1 OR dropoff_location_id > 265",
    "S10": "payment_type < 0 OR payment_type > 6",
    "S15": "passenger_count IS NULL OR rate_code_id IS NULL OR store_and_fwd_flag IS NULL"
    " OR congestion_surcharge IS NULL OR airport_fee IS NULL OR cbd_congestion_fee IS NULL",
    "S17": "trip_year IS NULL OR trip_month IS NULL OR trip_day IS NULL"
    " OR trip_weekday IS NULL OR pickup_hour IS NULL OR trip_duration_minutes IS NULL",
}
# These have to look at every row, in six columns.  Spark compares zone-less timestamps only
# after reading them, so the date range belongs here.
ROW_VIOLATIONS = {
    "S03": "pickup_datetime >= dropoff_datetime",
    "S07": "store_and_fwd_flag NOT IN ('Y', 'N')",
    "S11": "trip_status NOT IN ('valid', 'correction')",
    "S12": "trip_status = 'valid' AND fare_amount <= 0",
    "S13": "trip_status = 'valid' AND total_amount <= 0",
    "S14": "trip_status = 'correction' AND fare_amount > 0 AND total_amount > 0",
    "S16": "pickup_datetime < TIMESTAMP_NTZ'2021-01-01'"
    " OR pickup_datetime >= TIMESTAMP_NTZ'2026-01-01'",
}
SILVER_VIOLATIONS = {**RANGE_VIOLATIONS, **ROW_VIOLATIONS}

# The printed names.
SILVER_RULES = (
    Rule("S01: Silver not empty", passes="{} > 0"),
    Rule("S02: vendor_id in {1,2}"),
    Rule("S03: pickup < dropoff"),
    Rule("S04: duration 1-1440 min"),
    Rule("S05: passenger_count >= 0"),
    Rule("S06: trip_distance > 0"),
    Rule("S07: store_and_fwd Y/N"),
    Rule("S08: PU location 1-265"),
    Rule("S09: DO location 1-265"),
    Rule("S10: payment_type 0-6"),
    Rule("S11: trip_status valid/correction"),
    Rule("S12: valid fare > 0"),
    Rule("S13: valid total > 0"),
    Rule("S14: corrections negative"),
    Rule("S15: no NULLs in fixed cols"),
    Rule("S16: dates in 2021-2025"),
    Rule("S17: derived cols not NULL"),
)
DATA_LOSS_RULE = Rule(
    "S18: data loss < 10%",
    passes="{} > 0.90",
    # A whole number prints without a fraction.
    details="concat(regexp_replace(CAST(round((1 - {}) * 100, 2) AS STRING), '[.]0$', ''),"
    " '% lost')",
)


def _silver_measures(silver: DataFrame) -> DataFrame:
    def counts(violations: dict[str, str]) -> list[Column]:
        return [_violations(test, code) for code, test in violations.items()]

    out_of_range = " OR ".join(f"({test})" for test in RANGE_VIOLATIONS.values())
    return meet(
        silver.agg(_rows("S01"), *counts(ROW_VIOLATIONS)),
        silver.where(out_of_range).agg(*counts(RANGE_VIOLATIONS)),
    )


def _with_kept_share(measures: DataFrame) -> DataFrame:
    """S18 from the two counts; NULL, hence FAIL, for an empty raw table."""
    return measures.selectExpr("*", "try_divide(CAST(S01 AS DOUBLE), raw_rows) AS S18")


def quality_silver(silver: DataFrame, raw: DataFrame) -> DataFrame:
    """All 18 rules: a pass over six columns, one over suspect row groups, and a raw count."""
    measures = meet(_silver_measures(silver), raw.agg(_rows("raw_rows")))
    return _report(_with_kept_share(measures), (*SILVER_RULES, DATA_LOSS_RULE))


def quality_data_loss(silver: DataFrame, raw: DataFrame) -> DataFrame:
    measures = meet(silver.agg(_rows("S01")), raw.agg(_rows("raw_rows")))
    return _report(_with_kept_share(measures), (DATA_LOSS_RULE,))


# --- star schema -----------------------------------------------------------------------------

_BOTH_SIDES = "concat('Gold=', CAST({0}.gold AS STRING), ' Silver=', CAST({0}.silver AS STRING))"

# The printed names.
TABLE_RULES = (
    Rule("G01: dim_date not empty", passes="{} > 0"),
    Rule("G02: dates 2021-2025"),
    Rule("G03: no duplicate date_key", passes="{} = 1"),
    Rule("G04: dim_payment_type count = 7", passes="{} = 7"),
    Rule("G05: payment_category mapped"),
    Rule("G06: fact_trips not empty", passes="{} > 0"),
    Rule("G07: total_revenue >= 0"),
    Rule("G08: trip_count > 0"),
    Rule("G09: avg_trip_cost <= 1000"),
    Rule("G10: valid payment types"),
    Rule("G11: fact_corrections not empty", passes="{} > 0"),
    Rule("G12: correction_count is positive"),
    Rule("G13: valid payment types (corrections)"),
)
CROSS_LAYER_RULES = (
    Rule("G14: Gold = Silver valid count", "abs({0}.gold - {0}.silver) = 0", _BOTH_SIDES),
    Rule("G15: Gold = Silver correction count", "abs({0}.gold - {0}.silver) = 0", _BOTH_SIDES),
    Rule("G16: Gold revenue = Silver valid revenue", "abs({0}.gold - {0}.silver) < 1", _BOTH_SIDES),
)


def date_key_counts(dates: DataFrame) -> DataFrame:
    """Rows, rows outside the years and the most rows of one key, in one pass."""
    outside = "full_date < DATE'2021-01-01' OR full_date >= DATE'2026-01-01'"
    per_key = dates.groupBy("date_key").agg(_rows("key_rows"), _violations(outside, "outside"))
    return per_key.agg(
        _sum_or_zero("key_rows", "G01"),
        _sum_or_zero("outside", "G02"),
        F.expr("max(key_rows) AS G03"),
    )


def _payment_measures(payment_types: DataFrame) -> DataFrame:
    unmapped = "payment_category NOT IN ('Credit Card', 'Cash', 'Others')"
    return payment_types.agg(
        _rows("G04"),
        _violations(unmapped, "G05"),
        _violations("payment_key IS NULL", "null_payment_types"),
    )


def _trip_measures(fact: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Everything the rules need from fact_trips, in one pass over it."""
    per_key = fact.groupBy("payment_key").agg(
        _rows("fact_rows"),
        _violations("total_revenue < 0", "negative"),
        _violations("trip_count <= 0", "empty"),
        _violations("avg_trip_cost <= 0 OR avg_trip_cost > 1000", "cost"),
        F.expr("sum(trip_count) AS trips"),
        F.expr("sum(total_revenue) AS revenue"),
    )
    return _marked_unlisted(per_key, payment_types).agg(
        _sum_or_zero("fact_rows", "G06"),
        _sum_or_zero("negative", "G07"),
        _sum_or_zero("empty", "G08"),
        _sum_or_zero("cost", "G09"),
        _sum_or_zero("unlisted_rows", "unlisted_trips"),
        _sum_or_zero("trips", "gold_trips"),
        _revenue_or_zero("sum(revenue)", "gold_revenue"),
    )


def _correction_measures(fact: DataFrame, payment_types: DataFrame) -> DataFrame:
    per_key = fact.groupBy("payment_key").agg(
        _rows("fact_rows"),
        _violations("correction_count <= 0", "empty"),
        F.expr("sum(correction_count) AS corrections"),
    )
    return _marked_unlisted(per_key, payment_types).agg(
        _sum_or_zero("fact_rows", "G11"),
        _sum_or_zero("empty", "G12"),
        _sum_or_zero("unlisted_rows", "unlisted_corrections"),
        _sum_or_zero("corrections", "gold_corrections"),
    )


def _marked_unlisted(per_key: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Adds the fact rows of a non-NULL key that the dimension does not list.

    An outer join, because an anti join would need a second pass over the fact.
    """
    listed = payment_types.selectExpr("payment_key", "true AS listed").distinct()
    unlisted = "CASE WHEN listed IS NULL AND payment_key IS NOT NULL THEN fact_rows END"
    return per_key.join(listed, "payment_key", "left").selectExpr(
        "*", f"{unlisted} AS unlisted_rows"
    )


def _orphans(unlisted: str, fact_rows: str) -> str:
    """Fact rows whose key is NOT IN the dimension, as SQL defines it for NULL and for no rows."""
    return (
        f"CASE WHEN G04 = 0 THEN {fact_rows} WHEN null_payment_types > 0 THEN 0"
        f" ELSE {unlisted} END"
    )


def _with_orphans(measures: DataFrame) -> DataFrame:
    return measures.selectExpr(
        "*",
        f"{_orphans('unlisted_trips', 'G06')} AS G10",
        f"{_orphans('unlisted_corrections', 'G11')} AS G13",
    )


def _revenue_or_zero(revenue: str, alias: str) -> Column:
    return F.expr(f"CAST(coalesce({revenue}, 0) AS {TOTAL}) AS {alias}")


def _silver_totals(silver: DataFrame) -> DataFrame:
    valid_total = f"CASE WHEN trip_status = '{VALID}' THEN total_amount END"
    return silver.agg(
        _violations(f"trip_status = '{VALID}'", "silver_trips"),
        _violations(f"trip_status = '{CORRECTION}'", "silver_corrections"),
        _revenue_or_zero(total(sum_cents(valid_total)), "silver_revenue"),
    )


def _with_pairs(measures: DataFrame) -> DataFrame:
    def pair(name: str) -> str:
        return f"struct(gold_{name} AS gold, silver_{name} AS silver)"

    return measures.selectExpr(
        "*", f"{pair('trips')} AS G14", f"{pair('corrections')} AS G15", f"{pair('revenue')} AS G16"
    )


def quality_gold(
    dates: DataFrame,
    payment_types: DataFrame,
    trips: DataFrame,
    corrections: DataFrame,
    silver: DataFrame,
) -> DataFrame:
    """All 16 rules, with one pass over each fact, the calendar and the cleaned table."""
    measures = meet(
        date_key_counts(dates),
        _payment_measures(payment_types),
        _trip_measures(trips, payment_types),
        _correction_measures(corrections, payment_types),
        _silver_totals(silver),
    )
    judged = _with_pairs(_with_orphans(measures))
    return _report(judged, (*TABLE_RULES, *CROSS_LAYER_RULES))


def quality_cross_layer(trips: DataFrame, corrections: DataFrame, silver: DataFrame) -> DataFrame:
    """The three reconciliations of the facts with the cleaned table."""
    measures = meet(
        trips.agg(
            _sum_or_zero("trip_count", "gold_trips"),
            _revenue_or_zero("sum(total_revenue)", "gold_revenue"),
        ),
        corrections.agg(_sum_or_zero("correction_count", "gold_corrections")),
        _silver_totals(silver),
    )
    return _report(_with_pairs(measures), CROSS_LAYER_RULES)


def orphan_counts(
    fact: DataFrame, payment_types: DataFrame, lookups: Mapping[str, str]
) -> DataFrame:
    """Fact rows whose payment key is NOT IN each lookup: (lookup, orphan_rows).

    A lookup is the part of the dimension that meets its condition.  The fact is reduced to one
    row a key and meets the dimension once, whatever the number of lookups.
    """
    names = list(lookups)
    per_key = fact.groupBy("payment_key").agg(_rows("fact_rows"))
    listed = payment_types.groupBy("payment_key").agg(
        *(F.expr(f"count_if({lookups[n]}) > 0 AS listed_{i}") for i, n in enumerate(names))
    )
    outside = "CASE WHEN NOT coalesce(listed_{0}, false) AND payment_key IS NOT NULL THEN fact_rows END"
    measures = meet(
        payment_types.agg(
            *(_violations(lookups[n], f"size_{i}") for i, n in enumerate(names)),
            *(_violations(f"({lookups[n]}) AND payment_key IS NULL", f"nulls_{i}")
              for i, n in enumerate(names)),
        ),
        per_key.join(listed, "payment_key", "left").agg(
            _sum_or_zero("fact_rows", "all_rows"),
            *(_sum_or_zero(outside.format(i), f"outside_{i}") for i in range(len(names))),
        ),
    )
    return as_lines(
        measures,
        (
            {
                "lookup": text(name),
                "orphan_rows": f"CASE WHEN size_{i} = 0 THEN all_rows"
                f" WHEN nulls_{i} > 0 THEN 0 ELSE outside_{i} END",
            }
            for i, name in enumerate(names)
        ),
    )
