"""One row of measures -> one line per entry of a report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def as_lines(measures: DataFrame, lines: Iterable[Mapping[str, str]]) -> DataFrame:
    """Unpivots the single row: each line maps the output columns to expressions over it."""
    structs = (
        "struct(" + ", ".join(f"{sql} AS {name}" for name, sql in line.items()) + ")"
        for line in lines
    )
    return measures.selectExpr(f"inline(array({', '.join(structs)}))")


def meet(*one_row_frames: DataFrame) -> DataFrame:
    """One row holding the columns of all the one-row frames, without a cross join."""
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return united.agg(*(F.expr(f"max({name}) AS {name}") for name in united.columns))
