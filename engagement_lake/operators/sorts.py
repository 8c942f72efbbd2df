"""Rows of a sorted frame with their position, without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engagement_lake.sources.session import scratch_path

# An id that Spark gives a row is its task's number, shifted, plus its place in the task.
_TASK_BITS = 33


def with_positions(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Add each row's position from 1 in the order of ``ordered``, a frame that ends with a sort.

    Sorted tasks hold ranges in order. The rows are written once with their task and place; only the
    number of rows of each task is added up over the tasks.
    """
    path = scratch_path(ordered.sparkSession, "ordered")
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = ordered.sparkSession.read.parquet(path)
    rows = rows.withColumn("_task", F.shiftright("_id", _TASK_BITS))
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")
    begins = sizes.select("_task", before.alias("_before"))
    place = F.col("_id") - F.shiftleft(F.col("_task"), _TASK_BITS)
    numbered = rows.join(begins, "_task").withColumn(name, F.col("_before") + place + 1)
    return numbered.select(*ordered.columns, name)
