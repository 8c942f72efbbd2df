"""Rates, flags and text lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A view counts as completed from this share on.
COMPLETED_FROM = 0.95

# Inclusive upper bound and label of each engagement band, then the open-ended band.
SEGMENT_BANDS = (
    (0.25, "0-25%"),
    (0.50, "26-50%"),
    (0.75, "51-75%"),
)
TOP_SEGMENT = "76-100%"

# Fixed value: separator of the text lists.
LIST_SEPARATOR = " | "


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; 0.0 where the denominator is NULL or zero."""
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator != 0, quotient).otherwise(F.lit(0.0))


def play_rate(plays: Column, loads: Column) -> Column:
    """Plays per load; NULL, not 0.0, where there were no loads."""
    return F.try_divide(plays.cast("double"), loads.cast("double"))


def completed(percent_viewed: Column | str = "percent_viewed") -> Column:
    c = F.col(percent_viewed) if isinstance(percent_viewed, str) else percent_viewed
    return c >= F.lit(COMPLETED_FROM)


def engagement_segment(average: Column) -> Column:
    """Band of an average view share. NULL and values above 1 land in the top band."""
    (bound, label), *rest = SEGMENT_BANDS
    band = F.when(average <= bound, label)
    for bound, label in rest:
        band = band.when(average <= bound, label)
    return band.otherwise(TOP_SEGMENT)


def distinct_text(c: Column | str) -> Column:
    """Aggregate: the sorted distinct non-NULL values as one text, '' when there are none."""
    return F.array_join(F.array_sort(F.collect_set(c)), LIST_SEPARATOR)
