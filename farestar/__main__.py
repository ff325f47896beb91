"""Runs one step of the lake.

    spark-submit -m farestar land   --root URI --source URI [--years 2021 2025]
    spark-submit -m farestar silver --root URI [--overwrite]
    spark-submit -m farestar gold   --root URI [--overwrite]
    spark-submit -m farestar check  --root URI [--out URI]
    spark-submit -m farestar report --root URI --name overview --out URI [--format csv]

``land`` prints every month with its status, ``check`` every rule with its result.  ``report``
writes the whole report to ``--out``, ordered by its key columns.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from farestar.lake import DIM_DATE, DIM_PAYMENT_TYPE, FACT_CORRECTIONS, FACT_TRIPS, Lake, source_path
from farestar.plans import medallion, reports
from farestar.session import build_session
from farestar.sources.landing import land_years
from farestar.sources.months import FIRST_YEAR, LAST_YEAR

REPORTS = {
    "overview": (reports.overview, (FACT_TRIPS, DIM_DATE, DIM_PAYMENT_TYPE)),
    "revenue": (reports.revenue, (FACT_TRIPS, DIM_DATE, DIM_PAYMENT_TYPE)),
    "zones": (reports.zones, (FACT_TRIPS,)),
    "temporal": (reports.temporal, (FACT_TRIPS, DIM_DATE)),
    "corrections": (reports.corrections, (FACT_CORRECTIONS, DIM_DATE, DIM_PAYMENT_TYPE)),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="farestar")
    parser.add_argument("step", choices=("land", "silver", "gold", "check", "report"))
    parser.add_argument("--root", required=True, help="root of the lake")
    parser.add_argument("--source", help="where the monthly files are published")
    parser.add_argument("--years", nargs=2, type=int, default=(FIRST_YEAR, LAST_YEAR))
    parser.add_argument("--overwrite", action="store_true", help="replace an existing table")
    parser.add_argument("--name", choices=REPORTS, default="overview")
    parser.add_argument("--out", help="where a report or the results of check are written")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    options = parser.parse_args(arguments)
    if options.step == "land" and not options.source:
        parser.error("land needs --source")
    if options.step == "report" and not options.out:
        parser.error("report needs --out")
    return options


def write_ordered(df: DataFrame, options: argparse.Namespace) -> None:
    """All rows, ordered over the files by every column from the first; replaces ``--out``."""
    writer = df.orderBy(*df.columns).write.mode("overwrite")
    if options.format == "csv":
        writer.option("header", True).csv(options.out)
    else:
        writer.parquet(options.out)


def print_lines(df: DataFrame) -> None:
    """Rows of a result that is small by its nature: months of a calendar, rules."""
    for row in df.collect():
        print(*row, sep="\t")


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark, lake = build_session(), Lake(options.root)
    if options.step == "land":
        print_lines(land_years(
            spark, *options.years, lambda y, m: source_path(options.source, y, m), lake
        ))
    elif options.step == "silver":
        medallion.build_silver(spark, lake, options.overwrite)
    elif options.step == "gold":
        medallion.build_gold(spark, lake, options.overwrite)
    elif options.step == "check":
        results = medallion.check_silver(spark, lake).unionByName(medallion.check_gold(spark, lake))
        if options.out:
            write_ordered(results, options)
        else:
            print_lines(results)
    else:
        build, tables = REPORTS[options.name]
        gold = medallion.read_gold(spark, lake)
        write_ordered(build(*(gold[name] for name in tables)), options)


if __name__ == "__main__":
    main()
