"""Sorted lists of distinct values as text, built in segments, so that no task holds a long list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engagement_lake.functions.columns import LIST_SEPARATOR

SEGMENT_BYTES = 1 << 20


def text_segments(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    segment_bytes: int = SEGMENT_BYTES,
    separator: str = LIST_SEPARATOR,
    tasks: int | None = None,
) -> DataFrame:
    """(*keys, part, text): the sorted distinct non-NULL values of each group, cut into numbered texts.

    The texts of a group, in order of ``part`` from 0 and joined by the separator, are its list. Values are
    dealt by range of (keys, value), so that a group of any size lies in many tasks; each task cuts its
    run into texts of about ``segment_bytes``. A group without values has no rows.
    """
    values = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value")).distinct()
    ranges = [*keys, "_value"]
    dealt = values.repartitionByRange(tasks, *ranges) if tasks else values.repartitionByRange(*ranges)
    dealt = dealt.withColumn("_task", F.spark_partition_id())
    run = Window.partitionBy(*keys, "_task").orderBy("_value")
    before = F.sum(F.octet_length("_value") + len(separator.encode())).over(
        run.rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = dealt.withColumn("_cut", F.floor(F.coalesce(before, F.lit(0)) / segment_bytes))
    texts = cut.groupBy(*keys, "_task", "_cut").agg(
        F.array_join(F.array_sort(F.collect_list("_value")), separator).alias("text")
    )
    # Tasks hold ranges in order; a group has as many rows here as it has texts.
    in_order = Window.partitionBy(*[f"_of_{k}" for k in keys]).orderBy("_of_task", "_of_cut")
    places = texts.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_task").alias("_of_task"), F.col("_cut").alias("_of_cut")
    )
    numbers = places.withColumn("part", F.row_number().over(in_order) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    same += [F.col("_task") == F.col("_of_task"), F.col("_cut") == F.col("_of_cut")]
    return texts.join(numbers, same).select(*keys, "part", "text")


def whole_texts(segments: DataFrame, keys: Sequence[str], separator: str = LIST_SEPARATOR) -> DataFrame:
    """(*keys, text): each group's texts put together, for a writer that wants one cell per group."""
    parts = F.array_sort(F.collect_list(F.struct("part", "text")))
    return segments.groupBy(*keys).agg(F.array_join(parts.getField("text"), separator).alias("text"))
