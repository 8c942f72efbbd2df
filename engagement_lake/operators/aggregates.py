"""Aggregates shared by the dimension and mart builders."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engagement_lake.functions import completed, safe_divide

Mean = Callable[[Column], Column]


def view_measures(visitors_as: str, mean: Mean = F.avg) -> list[Column]:
    """Event count, distinct visitors, view shares and completed views of a group of events."""
    return [
        F.count("event_key").alias("engagement_event_count"),
        F.count_distinct("visitor_key").alias(visitors_as),
        mean(F.col("percent_viewed")).alias("avg_percent_viewed"),
        F.max("percent_viewed").alias("max_percent_viewed"),
        F.count_if(completed()).alias("completed_view_count"),
    ]


def share_of_events(count: str) -> Column:
    return safe_divide(F.col(count), F.col("engagement_event_count"))


def first_last_event() -> list[Column]:
    return [
        F.min("received_at").alias("first_event_at"),
        F.max("received_at").alias("last_event_at"),
    ]


class LatestValues:
    """Latest non-NULL value of several columns per group, in one mergeable aggregate.

    A plain ``max_by`` per column would carry the ordering key once per column through the
    shuffle. Columns that are usually present together (a "bundle") share it: rows that have the
    whole bundle keep one struct, and only rows with part of it fall back to a struct per
    column. The later of both is the exact per-column answer.

    ``order`` must identify a row within its group; NULL sorts lowest in it.
    """

    def __init__(self, order: Sequence[str], bundles: Sequence[Sequence[str]]):
        self.order = tuple(order)
        self.bundles = tuple(tuple(b) for b in bundles)

    @staticmethod
    def _present(columns: Sequence[str]) -> str:
        return " AND ".join(f"{c} IS NOT NULL" for c in columns)

    def _latest(self, columns: Sequence[str], keep: str, name: str) -> Column:
        row = ", ".join((*self.order, *columns))
        return F.expr(f"max(struct({row})) FILTER (WHERE {keep}) AS {name}")

    @property
    def aggregates(self) -> list[Column]:
        parts = []
        for n, bundle in enumerate(self.bundles):
            whole = self._present(bundle)
            parts.append(self._latest(bundle, whole, f"_whole_{n}"))
            if len(bundle) > 1:
                parts += [
                    self._latest([c], f"{c} IS NOT NULL AND NOT ({whole})", f"_part_{c}")
                    for c in bundle
                ]
        return parts

    def resolve(self, df: DataFrame) -> DataFrame:
        """Replace the aggregate structs by one column per value."""
        values = {}
        for n, bundle in enumerate(self.bundles):
            for c in bundle:
                fields = ", ".join(f"_whole_{n}.{f} AS {f}" for f in (*self.order, c))
                if len(bundle) > 1:
                    whole = f"CASE WHEN _whole_{n} IS NOT NULL THEN struct({fields}) END"
                    values[c] = F.expr(f"greatest({whole}, _part_{c}).{c}")
                else:
                    values[c] = F.col(f"_whole_{n}.{c}")
        helpers = [c for c in df.columns if c.startswith(("_whole_", "_part_"))]
        return df.withColumns(values).drop(*helpers)
