"""Exact distinct values and counts of many columns in one pass.

Several ``count(DISTINCT ..)`` side by side make Catalyst expand every row into one per column, each
with all columns and all other measures beside it, and shuffle that. Here a row is taken apart into
(column number, value) pairs, which the map task makes distinct before anything is shuffled. The
measures over whole rows travel on one pair of their own, so a map task sends one row of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pair that stands for the row as a whole.
_ROW = -1


@dataclass(frozen=True)
class Total:
    """A measure over rows that can be taken in parts: their ``sum``, ``min``, ``max``, or the ``count``
    of rows for which ``value`` is true."""

    kind: str
    value: Column

    def over_rows(self, c: Column) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count_if}[self.kind](c)

    def over_parts(self, c: Column) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}[self.kind](c)


def rows_total() -> Total:
    return Total("count", F.lit(True))


def _as_text(df: DataFrame, name: str) -> Column:
    """The value as text, equal for equal values."""
    kind = df.schema[name].dataType.simpleString()
    if kind in ("float", "double"):
        return (F.col(name) + F.lit(0.0)).cast("string")  # a negative zero equals zero
    return F.col(name).cast("string")


def column_values(
    df: DataFrame,
    columns: Sequence[str],
    totals: Mapping[str, Total] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(*keys, column_no, value, value_rows, *totals): each distinct value of each column, as text, and its rows.

    NULL is a value. The totals are on the rows of ``column_no`` -1, and NULL elsewhere. Columns are of
    atomic types and numbered as they are given.
    """
    totals = totals or {}
    kinds = df.select(*[t.value.alias(n) for n, t in totals.items()]).schema if totals else ()
    whole = [t.value.alias(n) for n, t in totals.items()]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]

    def pair(number: int, value: Column, carried: list[Column]) -> Column:
        return F.struct(F.lit(number).alias("column_no"), value.alias("value"), *carried)

    pairs = [pair(n, _as_text(df, c), none) for n, c in enumerate(columns)]
    if totals:
        pairs.append(pair(_ROW, F.lit(None).cast("string"), whole))
    apart = df.select(*keys, F.inline(F.array(*pairs)))
    measures = [t.over_rows(F.col(n)).alias(n) for n, t in totals.items()]
    return apart.groupBy(*keys, "column_no", "value").agg(F.count(F.lit(1)).alias("value_rows"), *measures)


def merged_totals(totals: Mapping[str, Total]) -> list[Column]:
    """Aggregates that put the totals of ``column_values`` together."""
    merged = {n: t.over_parts(F.when(F.col("column_no") == _ROW, F.col(n))) for n, t in totals.items()}
    return [
        (F.coalesce(c, F.lit(0)) if totals[n].kind == "count" else c).alias(n) for n, c in merged.items()
    ]


def distinct_counts(
    df: DataFrame,
    counted: Mapping[str, str],
    totals: Mapping[str, Total] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per group: the number of distinct non-NULL values of columns, by alias, and the totals.

    Without keys there is one row, also for an empty frame.
    """
    totals = totals or {}
    values = column_values(df, list(counted.values()), totals, keys)
    distinct = [
        F.count(F.when(F.col("column_no") == n, F.col("value"))).alias(alias) for n, alias in enumerate(counted)
    ]
    found = values.groupBy(*keys).agg(*distinct, *merged_totals(totals))
    return found.select(*keys, *counted, *totals)
