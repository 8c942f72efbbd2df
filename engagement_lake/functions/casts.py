"""Coercing casts for raw text: anything malformed becomes NULL, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _column(c).try_cast("double")


def _whole_number(c: Column | str, type_name: str) -> Column:
    # ANSI text-to-integer casts refuse "5.0", which JSON writers do emit for counts.
    return F.coalesce(_column(c).try_cast(type_name), to_double(c).try_cast(type_name))


def to_long(c: Column | str) -> Column:
    return _whole_number(c, "bigint")


def to_int(c: Column | str) -> Column:
    return _whole_number(c, "int")


def to_boolean(c: Column | str) -> Column:
    return _column(c).try_cast("boolean")


def to_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(_column(c))


def json_text(c: Column | str) -> Column:
    """Compact JSON text with sorted keys; text that is not JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(_column(c))), _column(c))


def section_parts(c: Column | str) -> tuple[Column, Column]:
    """(id, name) of a section that arrives either as plain text or as an object."""
    text = _column(c)
    object_id = F.get_json_object(text, "$.id")
    object_name = F.get_json_object(text, "$.name")
    is_object = object_id.isNotNull() | object_name.isNotNull()
    return to_long(object_id), F.when(is_object, object_name).otherwise(text)
