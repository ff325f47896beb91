"""Running totals of a large ordered table, in two levels."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window, functions as F

from farestar.llm.common import written


def running_totals(rows: DataFrame, order: list[str], values: list[str], group: list[str] | None = None) -> DataFrame:
    """``rows`` with ``<value>_before``: the sum of each value over the rows before, in its group.

    Rows are ranged by group and order.  Each range is summed up; what the driver gets is one
    total a range and group that lies in it, that is ranges plus groups at most, and sends back
    the offset of each.  Keys and values are integers, never NULL, and order is unique in a
    group.  The columns ``slice`` and ``<value>_base`` are taken.
    """
    group = group or []
    ranged = written(
        rows.repartitionByRange(*group, *order).withColumn("slice", F.spark_partition_id()), "scan_ranges"
    )
    totals = ranged.groupBy("slice", *group).agg(*(F.sum(v).cast("long").alias(v) for v in values))
    running: dict[tuple, list[int]] = defaultdict(lambda: [0] * len(values))
    offsets = []
    for row in sorted(totals.collect(), key=lambda r: r["slice"]):
        sums = running[tuple(row[g] for g in group)]
        offsets.append((row["slice"], *(row[g] for g in group), *sums))
        sums[:] = [a + row[v] for a, v in zip(sums, values)]
    kinds = dict(ranged.dtypes)
    schema = ", ".join([
        "slice int", *(f"{g} {kinds[g]}" for g in group), *(f"{v}_base bigint" for v in values)
    ])
    bases = F.broadcast(rows.sparkSession.createDataFrame(offsets, schema))
    inside = Window.partitionBy("slice", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    return summed.join(bases, ["slice", *group]).select(
        *rows.columns, *((F.col(f"{v}_base") + F.col(f"{v}_before")).alias(f"{v}_before") for v in values)
    )
