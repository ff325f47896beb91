"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder of the tables     (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores              (default 8)
    BENCH_REPEAT   timed runs, the best one counts (default 3)
    BENCH_NAIVE=0  leaves out the literal forms of some queries ("naive", and "ratio" to them)

Every query is run to the end of its plan without collecting rows, decimals in their own types.
"staging" holds the cold first builds of the tables that the queries read and is not part of the
value.  "fact_trips_from_lineitem" starts from the given table; its first run, which compiles the
code of the whole plan, is under "staging" too.
"""

from __future__ import annotations

import json
import os
import sys
import time

from farestar.lake import Lake
from farestar.operators import facts
from farestar.operators.cleaning import clean_trips
from farestar.plans import medallion
from farestar.session import build_session
from farestar.sources.bronze import merge_airport_fee
from harness import naive
from harness.registry import plain_queries
from harness.trips import derive_raw_fields, gold_tables, landed_lake, raw_fields, silver_trips

HEADLINE = (
    "month_grid", "missing_months", "bronze_scan", "bronze_airport_fee",
    "silver_trips", "silver_money", "silver_duration", "silver_calendar",
    "filter_duration", "filter_profile", "null_profile", "status_profile",
    "dim_date", "dim_payment_type", "fact_trips", "fact_corrections",
    "star_trips", "star_corrections",
    "quality_silver", "quality_gold", "quality_cross_layer", "quality_data_loss",
    "orphan_payment_trips", "orphan_payment_corrections",
    "orphan_keys_trips", "orphan_keys_corrections",
    "report_overview", "report_revenue", "report_zones", "report_temporal",
    "report_corrections",
)


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return time.perf_counter() - begun


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_naive(name: str, df, lake: Lake) -> None:
    """As the registered query is run: the cleaned table is written, results are drained."""
    if name == "build_silver":
        df.write.mode("overwrite").parquet(f"{lake.root}/naive_silver")
    else:
        drain(df)


def best(action, repeat: int) -> float:
    return round(min(timed(action) for _ in range(repeat)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    raw = merge_airport_fee(derive_raw_fields(spark, sf_dir))
    layers = {
        "fact_trips_from_lineitem": lambda: drain(facts.fact_trips(clean_trips(raw))),
        "derive_raw": lambda: raw_fields(spark, sf_dir),
        "build_silver": lambda: silver_trips(spark, sf_dir),
        "build_gold": lambda: gold_tables(spark, sf_dir),
        "land_months": lambda: landed_lake(spark, sf_dir),
    }
    staging = {name: round(timed(build), 3) for name, build in layers.items()}
    # The same builders, warm, on the landed months instead of the staged rows.
    landed = landed_lake(spark, sf_dir)
    lake = Lake(f"{landed.root}/rebuilt", bronze=landed.layer("bronze"))
    seconds = {
        "fact_trips_from_lineitem": best(layers["fact_trips_from_lineitem"], repeat),
        "build_silver": best(lambda: medallion.build_silver(spark, lake, overwrite=True), repeat),
        "build_gold": best(lambda: medallion.build_gold(spark, lake, overwrite=True), repeat),
    }

    queries = plain_queries()
    for name in HEADLINE:
        seconds[name] = best(lambda: drain(queries[name](spark, sf_dir)), repeat)
        print(name, seconds[name], file=sys.stderr, flush=True)

    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "staging": staging,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_NAIVE", "1") != "0":
        literal = {
            name: best(lambda: run_naive(name, form(spark, sf_dir), lake), repeat)
            for name, form in naive.FORMS.items()
        }
        report["naive"] = literal
        report["ratio"] = {name: round(seconds[name] / took, 2) for name, took in literal.items()}
    print(json.dumps(report), flush=True)


if __name__ == "__main__":
    main()
