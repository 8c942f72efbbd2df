"""Column expressions shared by the layers."""

from engagement_lake.functions.casts import (
    json_text,
    section_parts,
    to_boolean,
    to_double,
    to_int,
    to_long,
    to_timestamp,
)
from engagement_lake.functions.columns import (
    completed,
    distinct_text,
    engagement_segment,
    play_rate,
    safe_divide,
)

__all__ = [
    "completed",
    "distinct_text",
    "engagement_segment",
    "json_text",
    "play_rate",
    "safe_divide",
    "section_parts",
    "to_boolean",
    "to_double",
    "to_int",
    "to_long",
    "to_timestamp",
]
